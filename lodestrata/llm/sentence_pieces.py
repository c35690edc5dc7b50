"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text's symbols are merged by a score-ordered agenda: of all adjacent pairs that form a piece, the one of the best score
(of equal ones the leftmost) is merged, and the merged symbol's pairs with its neighbours join the agenda.  A chunk's
agenda is an array of the scores in the order of the text, whose maximum is found at once; that of a long chunk is a heap.  Symbols that are no piece fall
back to their bytes.  No piece of such a vocabulary has the space mark behind another character or a line end beside one,
so that a run of space marks, or a line end, is encoded alone with what follows it.  Signs that no piece has behind a
letter are cut from the words before them.  Each chunk that a worker hasn't met yet is encoded and decoded here and, in
the same Arrow batch, by the sentencepiece library; where the two disagree the job fails.  The joined ids of each whole
text are then decoded by the library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, steps, strings, trim, worker_state

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*")
#: Piece types of the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Signs that may be cut from words, and what marks such a chunk: no text of UTF-8 has it.
SIGNS, CUT = ".,!?;:*#%&$", "\ud800"
#: Chunks that a worker remembers, and as many older ones (together some 60 MB), and the longest of them.
REMEMBERED, LONGEST = 150_000, 48
#: Symbols from which a chunk's agenda is a heap; no pair's score is as low as NO_PAIR.
LONG_AGENDA, NO_PAIR = 64, float("-inf")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    types: tuple[int, ...]
    score: dict[str, float]
    number: dict[str, int]
    byte: tuple[int, ...]  # ids of the byte pieces
    unknown: int


def _fields(data: bytes):
    """(number, value) of a protocol buffer message; 32-bit values stay bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            length, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + length], at + length
        yield key >> 3, value


def read_vocabulary(model: bytes) -> Vocabulary:
    """The pieces of a serialised model.  Models of another kind, or that normalise more than spaces, are refused."""
    import struct

    pieces, types, scores = [], [], []
    for field, value in _fields(model):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
            types.append(piece.get(3, NORMAL))
        elif field == 2 and dict(_fields(value)).get(3, 1) != 2:
            raise ValueError("not a merge-type (BPE) vocabulary")
        elif field == 3:
            spec = dict(_fields(value))
            if spec.get(2) or not spec.get(3, 1) or spec.get(4, 1) or not spec.get(5, 1):
                raise ValueError("only models with identity normalisation, a leading space mark and kept spaces")
    mergeable = {p: i for i, (p, t) in enumerate(zip(pieces, types, strict=True)) if t in (NORMAL, USER_DEFINED, UNUSED)}
    if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in mergeable) or USER_DEFINED in types or UNUSED in types:
        raise ValueError("pieces with inner space marks or line ends, user-defined or unused pieces aren't supported")
    byte = tuple(i for i, t in enumerate(types) if t == BYTE)
    return Vocabulary(tuple(pieces), tuple(types), {p: scores[i] for p, i in mergeable.items()}, mergeable, byte, types.index(UNKNOWN))


def _merge_short(chunk: str, score: dict[str, float]) -> list[str]:
    """The symbols of a short chunk: ``agenda[i]`` is the score of symbols i and i + 1."""
    symbols, get = list(chunk), score.get
    agenda = [get(chunk[i : i + 2], NO_PAIR) for i in range(len(chunk) - 1)]
    while agenda and (best := max(agenda)) != NO_PAIR:
        i = agenda.index(best)
        symbols[i] = merged = symbols[i] + symbols.pop(i + 1)
        del agenda[i]
        if i < len(agenda):
            agenda[i] = get(merged + symbols[i + 1], NO_PAIR)
        if i:
            agenda[i - 1] = get(symbols[i - 1] + merged, NO_PAIR)
    return symbols


def _merge_long(chunk: str, score: dict[str, float]) -> list[str]:
    """The symbols of a chunk of any length, some of them empty."""
    symbols: list[str] = list(chunk)
    n = len(symbols)
    pairs = [chunk[i : i + 2] for i in range(n - 1)]
    agenda = [(-score[pair], i, i + 1, 2) for i, pair in enumerate(pairs) if pair in score]
    if agenda:
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(agenda)
        push, pop = heapq.heappush, heapq.heappop
        while agenda:
            _, left, right, length = pop(agenda)
            one, two = symbols[left], symbols[right]
            if not one or not two or after[left] != right or len(one) + len(two) != length:
                continue  # one of them has been merged meanwhile
            symbols[left], symbols[right] = merged, _ = one + two, ""
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                if (pair := merged + symbols[follower]) in score:
                    push(agenda, (-score[pair], left, follower, len(pair)))
            leader = before[left]
            if leader >= 0 and (pair := symbols[leader] + merged) in score:
                push(agenda, (-score[pair], leader, left, len(pair)))
    return symbols


def encode_chunk(chunk: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of a chunk by the agenda of adjacent pairs."""
    merge = _merge_short if len(chunk) < LONG_AGENDA else _merge_long
    ids, number, byte = [], vocabulary.number, vocabulary.byte
    for symbol in merge(chunk, vocabulary.score):
        if symbol:
            if symbol in number:
                ids.append(number[symbol])
            elif byte:
                ids += [byte[b] for b in symbol.encode("utf-8", "surrogatepass")]
            else:
                ids.append(vocabulary.unknown)
    return ids


def decode_ids(ids: list[int], vocabulary: Vocabulary, begins: bool = True) -> str:
    """The text of ids; ``begins``: the first space mark is the one that encoding put there."""
    out, pending = [], bytearray()
    for i in ids:
        kind = vocabulary.types[i]
        if kind == BYTE:
            pending.append(int(vocabulary.pieces[i][3:5], 16))
            continue
        if pending:
            out.append(pending.decode("utf-8", "replace"))
            pending.clear()
        if kind == UNKNOWN:
            out.append(" ⁇ ")
        elif kind != CONTROL:
            out.append(vocabulary.pieces[i])
    if pending:
        out.append(pending.decode("utf-8", "replace"))
    text = "".join(out).replace(SPACE, " ")
    return text[1:] if begins and text[:1] == " " else text


class Encoder:
    """Encodes batches of texts and remembers chunks: when the memory is full, those not met again since it was last full go.

    A chunk's ids are remembered as text.  The library decodes the joined ids of each whole text.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.vocabulary = read_vocabulary(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        signs = [s for s in SIGNS if not any(re.search(f"[A-Za-z]{re.escape(s)}", p) for p in self.vocabulary.number)]
        self.tail = re.compile(rf"(?<=[A-Za-z])([{re.escape(''.join(signs))}]+)(?=[ \n]|\Z)") if signs else re.compile("(?!)()")
        self.numeral = [str(i) for i in range(len(self.vocabulary.pieces))]
        self.value = {n: i for i, n in enumerate(self.numeral)}

    def _learn(self, chunks: list[str]) -> dict[str, str]:
        """Chunks are given without their first space mark; line ends and signs that were cut have none.

        The library begins with a space mark; signs are given to it behind a letter.
        """
        checks = self.library.encode(["a" + c[1:] if c[:1] == CUT else c for c in chunks], num_threads=1)
        vocabulary, numeral = self.vocabulary, self.numeral
        new, every, mark, letter = {}, [], encode_chunk(SPACE, vocabulary), encode_chunk(SPACE + "a", vocabulary)
        for chunk, check in zip(chunks, checks, strict=True):
            if chunk[:1] == "\n":
                ids, check = encode_chunk(chunk, vocabulary), check[len(mark) :]
            elif chunk[:1] == CUT:
                ids, check = encode_chunk(chunk[1:], vocabulary), check[len(letter) :]
            else:
                ids = encode_chunk(SPACE + chunk, vocabulary)
            if chunk and ids != check:  # the library drops an empty text, which is a chunk of one mark here
                raise ValueError(f"agenda and library disagree on the ids of {chunk!r}")
            new[chunk] = ",".join([numeral[i] for i in ids])
            every.append(ids)
        for ids, check in zip(every, self.library.decode(every, num_threads=1), strict=True):
            if check != decode_ids(ids, vocabulary):
                raise ValueError(f"decoding here and by the library disagree on {ids}")
        return new

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            return [c[1:] if c[0] == SPACE else c for c in CHUNK.findall(SPACE + text.replace(" ", SPACE))]
        return self.tail.sub(f" {CUT}\\1", text).replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, ids joined by commas, and decoded text of each text."""
        return self.decode(self.ids(texts))

    def ids(self, texts: list[str]) -> list[str]:
        """The ids of each text, joined by commas."""
        cut = [self.chunks(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, {}
            new = set().union(*cut)
        older = self.older
        again = {c: older[c] for c in new if c in older}
        self.known.update(again)
        self.known.update(self._learn(list(new.difference(again))))
        get = self.known.__getitem__
        out = [",".join(map(get, own)) for own in cut]
        for chunk in new:
            if len(chunk) > LONGEST:
                del self.known[chunk]
        return out

    def decode(self, ids: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, the ids, and the text that the library decodes from them, for each text's ids."""
        value = self.value.__getitem__
        numbers = [list(map(value, x.split(","))) if x else [] for x in ids]
        return list(zip(map(len, numbers), ids, self.library.decode(numbers, num_threads=1), strict=True)) if numbers else []


def piece_columns(spark, model: bytes):
    """A column function text -> struct(n_tokens, ids, decoded); ids are decimal and joined by commas."""
    small_batches(spark)

    @F.arrow_udf("struct<n_tokens: bigint, ids: string, decoded: string>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_state(f"pieces-{hashlib.sha256(model).hexdigest()}", lambda: Encoder(model))
        for texts in batches:
            rows, counts, ids, decoded = strings(texts), [], [], []
            for lo, hi in steps([len(t) for t in rows], 1 << 19):
                for n, own, text in encoder.encode(rows[lo:hi]):
                    counts.append(n)
                    ids.append(own)
                    decoded.append(text)
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids", "decoded"])
        trim()

    return pieces


def encode_pieces(docs: DataFrame, model: bytes, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row, without begin and end ids.

    Null and empty texts have no ids and decode to an empty text.  Whole texts of any length are encoded; chunks over
    ``LONGEST`` characters are encoded each time they are met.  A chunk on which agenda and library disagree stops the
    job.  Repeated rows are encoded each; an empty table gives no rows; other columns are not read, so their names can't
    clash.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), piece_columns(docs.sparkSession, model)(F.col(text)).alias("_p")).select("doc_id", "_p.*")


def digest_pieces(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    return digest_pieces(encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), model))
