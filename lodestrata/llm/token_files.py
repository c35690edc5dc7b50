"""Token ids as binary blocks with Elias-Fano boundaries.

A block holds the ids of some thousand documents in one array, and three Elias-Fano lists: where each document ends, and
the distances of the documents' ids from the block's least one.  An Elias-Fano list of n values up to u keeps the low
log2(u/n) bits of each value packed and the rest as a bit vector of at most 3n bits; ``select`` finds the i-th set bit
from samples of every 256th, ``select_many`` those of many documents at once, so that no table of 64-bit offsets is needed.

Blocks are rows of a Parquet table, so that a retried or doubled task leaves no torn file: ``part`` and ``block`` order
them, ``before`` is the number of ids of the same part before the block, ``payload`` the bytes.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import blobs, keep, small_batches, steps, worker_state

MAGIC = b"EFTOK1\0\0"
SAMPLE = 256
BLOCK_IDS, BLOCK_DOCS = 2_000_000, 20_000
REMEMBERED, LONGEST = 700_000, 40
WORDS_AT_ONCE = 20_000
BLOCKS = "part int, block int, before long, n_docs long, n_ids long, payload binary"


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: For each byte its number of set bits, and the place of each of them.
ONES = _BITS.sum(axis=1, dtype=np.int64)
PLACES = np.argsort(1 - _BITS, axis=1, kind="stable").astype(np.int64)


class EliasFano:
    """A list of non-decreasing values from 0 up."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (most // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, bool)
        high[ones] = True
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """Position of the i-th set bit of the high part."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        value = self.select(i) - i
        for b in range(self.low_bits - 1, -1, -1):
            at = i * self.low_bits + b
            value = value * 2 + (int(self.low[at >> 3]) >> (at & 7) & 1)
        return value

    def select_many(self, index: np.ndarray) -> np.ndarray:
        """Positions of several set bits: by the number of ones before each byte, and a table of a byte's bits."""
        before = np.concatenate([[0], np.cumsum(ONES[self.high])])
        byte = np.searchsorted(before, index, side="right") - 1
        return byte * 8 + PLACES[self.high[byte], index - before[byte]]

    def many(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, np.uint64)
        values = (self.select_many(index) - index).astype(np.uint64)
        for b in range(self.low_bits - 1, -1, -1):
            at = index * self.low_bits + b
            values = values * np.uint64(2) + (self.low[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        return values

    def all(self) -> np.ndarray:
        return self.many(np.arange(self.n))

    def to_bytes(self) -> bytes:
        return struct.pack("<QQQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, low_bits, low, high = struct.unpack_from("<QQQQ", data, at)
        at += 32
        samples = -(-n // SAMPLE)
        out = cls(n, low_bits, np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low), np.frombuffer(data, "<u4", samples, at + low + high))
        return out, at + low + high + 4 * samples


def pack_block(doc_ids: list[int | None], ends: np.ndarray, ids: bytes, width: int) -> bytes:
    """Ids are little-endian and ``width`` bytes wide; documents ascend by id, those without an id come first."""
    none = sum(d is None for d in doc_ids)
    least = doc_ids[none] if none < len(doc_ids) else 0
    distances = np.array([d - least for d in doc_ids[none:]], np.uint64)
    return MAGIC + struct.pack("<QQqQ", width, none, least, len(ids)) + EliasFano.encode(ends).to_bytes() + EliasFano.encode(distances).to_bytes() + ids


class Block:
    """Reads a block: any document's ids without the others'."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token block")
        self.width, self.none, self.least, length = struct.unpack_from("<QQqQ", data, 8)
        self.ends, at = EliasFano.from_bytes(data, 40)
        self.distances, at = EliasFano.from_bytes(data, at)
        if self.width not in (2, 4) or len(data) != at + length:
            raise ValueError("a torn token block")
        self.ids = np.frombuffer(data, f"<u{self.width}", length // self.width, at)

    def __len__(self) -> int:
        return self.ends.n

    def doc_ids(self) -> list[int | None]:
        return [None] * self.none + [self.least + int(d) for d in self.distances.all()]

    def offsets(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of the documents at ``index`` begin and end, by ``select`` on the boundaries."""
        ends = self.ends.many(index).astype(np.int64)
        begins = np.zeros(len(ends), np.int64)
        begins[index > 0] = self.ends.many(index[index > 0] - 1)
        return begins, ends

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]


#: Signs behind a word, up to the next white space.  A tokenizer that cuts words from signs has the same ids with a blank
#: between them; only ASCII is looked at, where a sign is certain to be one.
TAIL = re.compile(rb"(?<=[a-z0-9])([.,!?;:*#%&$]+)(?=[\x20\x09-\x0D]|$)")


class WordEncoder:
    """Ids of texts by the tokenizers library, word by word.

    The tokenizer cuts at white space, and words from signs, before it merges, so that a text's ids are those of its words
    and signs.  That is checked on loading; with another tokenizer whole texts go to the library.
    """

    def __init__(self, definition: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[bytes, bytes] = {}
        probe = ["The\tquick  brown", "fox's 12\n3", "Über", "été", "...  !"]
        apart = [i for t in probe for w in TAIL.sub(rb" \1", t.lower().encode()).decode().split() for i in self._ids([w])[0]]
        self.by_word = self._word_bytes(words := [w.encode() for w in " ".join(probe).split()]) == self._bytes(words) and apart == [i for ids in self._ids(probe) for i in ids] == self._ids([" ".join(probe)])[0] == self._ids([" ".join(probe).lower()])[0]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, texts: list[bytes]) -> list[bytes]:
        kind = f"<u{self.width}"
        return [np.array(ids, kind).tobytes() for ids in self._ids([t.decode("utf-8", "replace") for t in texts])]

    def _word_bytes(self, words: list[bytes]) -> list[bytes]:
        """The same for words, of which the library takes many at once and tells whose each id is."""
        kind, out = f"<u{self.width}", []
        for lo in range(0, len(words), WORDS_AT_ONCE):
            some = [w.decode("utf-8", "replace") for w in words[lo : lo + WORDS_AT_ONCE]]
            done = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(np.array(done.word_ids, np.int64), minlength=len(some))) * self.width
            data, at = np.array(done.ids, kind).tobytes(), 0
            for end in ends.tolist():
                out.append(data[at:end])
                at = end
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._bytes(texts)
        # Letters A to Z are lowered before; a special token would only be met in its own spelling.
        cut = [t.split() if b"<|" in t else TAIL.sub(rb" \1", t.lower()).split() for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = set().union(*cut)
        order = list(new)
        self.known.update(zip(order, self._word_bytes(order), strict=True))
        get = self.known.__getitem__
        out = [b"".join(map(get, own)) for own in cut]
        for word in order:
            if len(word) > LONGEST:
                del self.known[word]
        return out


def _writer(definition: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"words-{zlib.crc32(definition.encode())}", lambda: WordEncoder(definition))
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids, docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, before, ids, docs, size
            ends = np.cumsum([len(x) // encoder.width for x in ids])
            total = int(ends[-1])
            out = pa.RecordBatch.from_pylist([{"part": part, "block": block, "before": before, "n_docs": len(docs), "n_ids": total, "payload": pack_block(docs, ends, b"".join(ids), encoder.width)}], _SCHEMA)
            block, before, ids, docs, size = block + 1, before + total, [], [], 0
            return out

        for batch in batches:
            parts, names = blobs(batch["text"]), batch["doc_id"].to_pylist()
            for lo, hi in steps([len(p) for p in parts]):
                for name, own in zip(names[lo:hi], encoder.encode(parts[lo:hi]), strict=True):
                    ids.append(own + end)
                    docs.append(name)
                    size += len(own) // encoder.width + 1
                    if size >= BLOCK_IDS or len(docs) >= BLOCK_DOCS:
                        yield flush()
        if docs:
            yield flush()

    return write


_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])


def write_tokens(docs: DataFrame, definition: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode all texts and write them as blocks in ascending order of the id; returns the written table.

    Null and empty texts have the end id only.  Rows without an id come first; rows with one id are ordered by a hash of
    their text.  An empty table gives no blocks.  Other columns are not read, so their names can't clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return keep(ordered.mapInArrow(_writer(definition, end_id), BLOCKS), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, start in zip(batch["payload"].to_pylist(), batch["start"].to_pylist(), strict=True):
            block = Block(data)
            begins, ends = block.offsets(np.arange(len(block)))
            crc = [zlib.crc32(block.ids[b:e].astype("<u4").tobytes()) for b, e in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids(), pa.int64()), pa.array(begins + start), pa.array(ends - begins), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document from its block; ``start`` counts the ids of all documents before.

    The ids before a part are summed over the parts, of which there are as many as range partitions were written.
    """
    from pyspark.sql import Window

    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    rows = blocks.select("part", "before", "payload").join(F.broadcast(base), "part")
    return rows.select((F.col("base") + F.col("before")).alias("start"), "payload").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    return read_tokens(write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), definition, end_id=1))
