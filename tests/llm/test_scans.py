"""Secret scan, personal data, SentencePiece, token files and language identification against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.llm import language_id as L
from lodestrata.llm import pii
from lodestrata.llm import secret_scan as S
from lodestrata.llm import sentence_pieces as SP
from lodestrata.llm import token_files as TF

BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)
PIECES = ["password", "PassWd", "secret", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "A", "Z9", "abc", "0123456789abcdef", "deadbeef", "é", "\n", "/", ".", "_", "日"]
WEIRD = [None, "", "   ", "12345", "token = abcdef", "a" * 300_000, "é" * 1000, "token=" + "f" * 50]


def secrets(text):
    return sorted((m.start(), k, m.end()) for k, (_, r, ok) in enumerate(BASE) for m in r.finditer(text) if ok(m))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=50).map("".join), max_size=20))
def test_secrets_like_re(texts):
    found = S.find_secrets([t.encode() for t in texts], S.scanner())
    assert [[x for x in own if x[1] < 3] for own in found] == [secrets(t) for t in texts]


def test_more_secrets():
    text = "x ghp_" + "g1" * 12 + " -----BEGIN RSA PRIVATE KEY----- xoxb-" + "1" * 12 + " ghp_short"
    assert [S.scanner().rules[r].kind for _, r, _ in S.find_secrets([text.encode()], S.scanner())[0]] == ["github", "private_key", "slack"]


def test_automata_are_minimal_and_any_lane_count_agrees():
    machine = S.scanner()
    text = ("token = 0123456789abcdef0123456789 AKIA" + "Z" * 16 + " ") * 400
    buffer = np.frombuffer(text.encode(), np.uint8)
    state, hits = 0, []
    for i, c in enumerate(machine.together.class_of[buffer].tolist()):
        state = int(machine.together.step[state + c])
        if state >= machine.together.accepting:
            hits.append(i)
    assert S.scan(buffer, machine.together)[0].tolist() == hits


def test_secrets_of_long_texts():
    """Texts of a megabyte with many hits, and hits in some texts of a batch only."""
    rng = np.random.default_rng(12)
    filler = ["word ", "abc ", "the deadbeef ", "token ", "= ", "é", "AKIA ", "key:"]
    hits = ["token = abcdefgh ", "0123456789abcdef" * 3 + " ", "AKIA" + "Z9" * 10 + " ", "secret:'x1x1x1x1' "]
    long = ["".join(rng.choice(filler + hits, 60_000, p=[0.12] * 8 + [0.01] * 4)) for _ in range(2)]
    texts = ["none here", *long, "", "token = abcdefgh", "f" * 200_000, "no"]
    found = S.find_secrets([t.encode() for t in texts], S.scanner())
    assert [[x for x in own if x[1] < 3] for own in found] == [secrets(t) for t in texts]


def test_secret_query(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(WEIRD)], "doc_id long, text string, found string")
    rows = S.digest_spans(S.scan_secrets(docs), [k for k, _, _ in BASE]).orderBy("doc_id").collect()
    for row, text in zip(rows, WEIRD, strict=True):
        want = ",".join(f"{BASE[k][0]}:{b}:{e}" for b, k, e in secrets(text or ""))
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and row["spans"] == want
    assert S.scan_secrets(docs.limit(0)).count() == 0


PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m, d: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m, d: all(int(x) < 256 for x in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m, d: 12 <= len(d) <= 19 and luhn(d)),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m, d: 9 <= len(d) <= 15),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def private(text):
    return sorted((m.start(), k, m.end()) for k, (_, r, ok) in enumerate(PII) for m in r.finditer(text) if ok(m[0], re.sub("[^0-9]", "", m[0])))


def test_private_like_re(spark):
    rng = np.random.default_rng(4)
    parts = ["a", ".", "@", "x-y", "_", "%", " ", "1", "25", "255", "256", "4111111111111111", "-", "+", "(", "555", ")", "é", "\n", "b.c", "日", "+1 (555) 123-4567", "0"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(1500)] + ["1 " * 20_000, "a" * 50_000 + "@b.c", ""]
    rows = pii.base_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in rows:
        assert [(s["begin"], list(pii.BASE).index(s["kind"]), s["end"]) for s in row["found"]] == private(row["text"])


def test_disclosing_terms(spark):
    """A term that stands only near one entity is removed where the entity is; common terms and clean documents stay."""
    rows = [(i, f"the agent Zorblax wrote to spy@example.com about the {w}") for i, w in enumerate(["one", "two", "three", "four"])]
    rows += [(10 + i, f"the agent wrote about the {i}") for i in range(40)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit(1))
    out = {r["doc_id"]: r for r in pii.find_private(docs).collect()}
    assert len(out) == len(rows)
    for i in range(4):
        assert [s["kind"] for s in out[i]["found"]] == ["email"]
        terms = {s["value"].lower() for s in out[i]["terms"]}
        assert "zorblax" in terms and not terms & {"the", "agent", "wrote"}
    assert all(not out[i]["terms"] and not out[i]["found"] for i in out if i >= 10)
    clean = pii.find_private(docs).join(docs.select("doc_id", "text"), "doc_id").filter("doc_id = 0").select(pii.sanitised(F.col("text"), F.concat("found", "terms"))).first()[0]
    assert "[EMAIL]" in clean and "Zorblax" not in clean and "agent" in clean
    assert pii.find_private(docs.limit(0)).count() == 0


def test_what_entities_have_in_common(spark):
    """No address occurs twice, but their domain does, and a term tells it; repeated rows get the same spans."""
    rows = [(i, f"Quorvex wrote to a{i}@rare.example and from 10.1.{i}.7") for i in range(8)] + [(100 + i, f"others wrote to b{i}@common{i}.example") for i in range(80)]
    rows += [rows[0], rows[0], (None, "Quorvex b@rare.example")]
    out = pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    for r in out:
        text = dict(rows)[r["doc_id"]]
        assert all(text[s["begin"] : s["end"]] == s["value"] for s in [*r["found"], *r["terms"]])
        assert {s["value"] for s in r["terms"]} & {"Quorvex", "wrote", "others"} == ({"Quorvex"} if "Quorvex" in text else set())
        assert "@" not in r["sanitised"] and "Quorvex" not in r["sanitised"] and not re.search(r"\d+\.\d+\.", r["sanitised"])


def test_sanitised_like_slicing(spark):
    """Against slices, with overlapping spans; a text of 20,000 spans takes seconds."""
    import time

    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["a", "é", "日", " ", "7", "x@y.zz "], 200)) for _ in range(40)] + ["", "a"]
    spans = [sorted({(int(b), int(b + n), "email" if k else "term", "x") for b, n, k in zip(rng.integers(0, 190, 12), rng.integers(1, 9, 12), rng.integers(0, 2, 12))}) if len(t) > 200 else [] for t in texts]
    frame = spark.createDataFrame(list(zip(texts, spans)), "text string, spans array<struct<begin: int, end: int, kind: string, value: string>>")
    for row in frame.select("text", "spans", pii.sanitised(F.col("text"), F.col("spans")).alias("out"), pii.masked(F.col("text"), F.col("spans")).alias("mask")).collect():
        out, at = "", 0
        for s in sorted(row["spans"], key=lambda s: (s["begin"], s["end"], s["kind"])):
            if s["begin"] >= at:
                out += row["text"][at : s["begin"]] + ("[EMAIL]" if s["kind"] == "email" else "")
            at = max(at, s["end"])
        hidden = {i for s in row["spans"] for i in range(s["begin"], s["end"])}
        assert row["out"] == out + row["text"][at:] and row["mask"] == "".join("\0" if i in hidden else c for i, c in enumerate(row["text"]))
    long = " and ".join(f"u{i}@mail{i}.example" for i in range(20_000))
    docs = spark.createDataFrame([(1, long)], "doc_id long, text string").withColumn("sanitised", F.lit(1))
    began = time.time()
    (row,) = pii.find_private(docs).collect()
    assert len(row["found"]) == 20_000 and row["sanitised"] == " and ".join(["[EMAIL]"] * 20_000)
    assert time.time() - began < 90


def test_disclosing_terms_anywhere_in_the_text(spark):
    """In 1000 documents, a term in just the 10 documents of an entity is near it in 3, and far from it in the others."""
    filler = " ".join(["the and of with"] * 100)
    rows = [(i, f"Zorblax {'' if i < 3 else filler} x@example.com {filler}") for i in range(10)]
    rows += [(10 + i, f"two@example.com {filler} pair") for i in range(2)] + [(12 + i, filler) for i in range(988)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = lambda **how: {r["doc_id"]: {s["value"] for s in r["terms"] if s["kind"] == "term"} for r in pii.find_private(docs, **how).collect()}
    got = terms()
    assert all("Zorblax" in got[i] for i in range(10)) and not any(got[i] for i in range(10, 1000))
    assert all(terms(min_support=2)[i] == {"pair"} for i in (10, 11))


@pytest.mark.parametrize("few", [pii.SMALL_ROWS, 0])
@pytest.mark.parametrize("min_support", [1, 3])
def test_disclosing_terms_by_counting(spark, monkeypatch, few, min_support):
    monkeypatch.setattr(pii, "SMALL_ROWS", few)
    rng = np.random.default_rng(9)
    texts = [" ".join([*(f"w{x}" for x in (rng.zipf(1.3, 30) % 150)), *(f"e{x}@a.b" for x in rng.integers(0, 40, rng.integers(0, 3)))]) for _ in range(300)]
    texts += texts[:20] * 4 + [None, ""]
    rows = [(i % 290, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 3
    held = [({f"email:{m}" for m in re.findall(r"e\d+@a\.b", t or "")}, set(re.findall(r"[a-z0-9]+", t or ""))) for _, t in rows]
    of_entity, of_term, of_both = Counter(e for x, _ in held for e in x), Counter(t for _, y in held for t in y), Counter((e, t) for x, y in held for e in x for t in y)
    want = {}
    for (e, t), n in of_both.items():
        ratio = 1 + np.log2(n / of_term[t]) / np.log2(len(rows) / of_entity[e])
        assert min(abs(ratio - 0.97), abs(ratio - 0.7)) > 1e-9
        if n >= min_support and ratio >= 0.7:
            want.setdefault(e, (set(), set()))[int(ratio < 0.97)].add(t)
    assert sum(len(b) for _, b in want.values()) > 9
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("body", F.md5(F.coalesce("text", F.lit(""))))
    entities = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"e\d+@a\.b"), F.lit(0)), lambda m: F.concat(F.lit("email:"), m)))
    found = docs.select("body", entities.alias("entities"), pii._words(F.col("text")).alias("words"))
    got = pii.disclosing_terms(docs, found, "text", min_support, 0.97, 0.7).collect()
    assert {r["entity"]: (set(r["removed"]), set(r["generalised"])) for r in got} == want


def test_a_domain_with_many_terms(spark, monkeypatch):
    """A text gets its own words of the 240 terms of its domain, and what is broadcast has few bytes."""
    monkeypatch.setattr(pii, "SMALL_BYTES", 8000, raising=False)
    sent = []
    monkeypatch.setattr(F, "broadcast", lambda df, send=F.broadcast: (sent.append(df), send(df))[1])
    own = [[f"word{chr(97 + g)}{chr(97 + i)}" for i in range(20)] for g in range(12)]
    rows = [(3 * g + k, f"no {k} {' '.join(own[g])} u{g}@rare.example") for g in range(12) for k in range(3)] + [(100 + i, f"no {i % 3}") for i in range(300)]
    out = pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: sorted(s["value"] for s in r["terms"]) for r in out} == {i: own[i // 3] if i < 36 else [] for i, _ in rows}
    sizes = [df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0 for df in sent]
    assert sizes and max(sizes) < 16_000


def test_terms_in_any_case_and_beside_spans(spark):
    """Words are found that match a term by case folding only, or that a masked value cuts."""
    found = ["silex istanbulx straßex vau", "Silex Istanbulx Straßex Vau", "SILEX ISTANBULX vau straßex", "\u017filex \u0130stanbulx STRA\u1e9eEX vau1.2.3.4"]
    rows = [(i, f"the {t} x@rare.example") for i, t in enumerate(found)] + [(10 + i, f"the {i}") for i in range(60)]
    out = pii.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: {s["value"] for s in r["terms"]} - {"x"} for r in out} == {i: set(found[i].replace("1.2.3.4", "").split()) if i < 4 else set() for i, _ in rows}


MODEL = SP.model_bytes(P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoder():
    return SP.Encoder(MODEL)


@settings(max_examples=150, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["▁", " ", "  ", "the", "\n", " \n", "é", "😀", "ing", "<s>", "<0x41>", "\x00", "tion", "x" * 60, ".", ",", "!!", "%%%", "#", ";:", "é."]), max_size=20).map("".join)))
def test_pieces_like_the_library(encoder, text):
    n, written, decoded = encoder.encode([text])[0]
    ids = [int(i) for i in written.split(",") if i]
    assert ids == encoder.library.encode(text) and n == len(ids)
    assert decoded == SP.decode_ids(ids, encoder.vocabulary) == encoder.library.decode(ids)


def test_short_and_long_agendas_agree(encoder, monkeypatch):
    draw = random.Random(3)
    pieces = list(encoder.vocabulary.number)
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 9))) for _ in range(2000)] + ["".join(draw.choice("aeinth.é日😀0") for _ in range(60)) for _ in range(500)]
    short = [SP.encode_chunk(t, encoder.vocabulary) for t in texts]
    monkeypatch.setattr(SP, "LONG_AGENDA", 0)
    assert short == [SP.encode_chunk(t, encoder.vocabulary) for t in texts]


def test_forgotten_chunks_are_learned_again(encoder, monkeypatch):
    monkeypatch.setattr(SP, "REMEMBERED", 20)
    texts = [f"word{i % 31} and number {i} or {i % 7}" for i in range(300)]
    got = [row for i in range(0, 300, 3) for row in encoder.encode(texts[i : i + 3])]
    assert got == [(len(ids), ",".join(map(str, ids)), t) for t, ids in zip(texts, encoder.library.encode(texts), strict=True)]
    assert len(encoder.known) <= 20 and len(encoder.older) <= 20


def test_disagreement_is_refused():
    """An encoder that lacks a piece doesn't pass the library's ids off as its own."""
    wrong = SP.Encoder(MODEL)
    del wrong.vocabulary.score["▁the"]
    with pytest.raises(ValueError, match="disagree"):
        wrong.encode(["the other then"])


def test_decoded_text_follows_the_ids(encoder):
    """The decoded text is what the ids say, not the text that was encoded."""
    (n, ids, decoded), (_, other, _) = encoder.encode(["the other then", "a quite different one"])
    assert encoder.decode([ids, other, ""]) == [(n, ids, decoded), (len(other.split(",")), other, "a quite different one"), (0, "", "")]
    changed = ",".join([other.split(",")[0], *ids.split(",")[1:]])
    assert encoder.decode([changed])[0][2] == encoder.library.decode([int(i) for i in changed.split(",")]) != decoded


def test_very_long_and_repeated_texts(spark):
    long = " ".join(f"word{i % 5000}, Ä{i}" for i in range(300_000)) + " " + "x" * 20_000
    rows = spark.createDataFrame([(1, long), (1, long), (2, "same"), (2, "same"), (2, None)], "doc_id long, text string")
    out = SP.encode_pieces(rows, MODEL).collect()
    library = SP.Encoder(MODEL).library
    ids = library.encode(long)
    assert [(r["n_tokens"], r["ids"] == ",".join(map(str, ids)), r["decoded"] == library.decode(ids)) for r in out if r["doc_id"] == 1] == [(len(ids), True, True)] * 2
    assert sorted(r["decoded"] for r in out if r["doc_id"] == 2) == ["", "same", "same"]


def test_piece_query(spark, encoder):
    docs = spark.createDataFrame(list(enumerate(WEIRD[:5] + ["word " * 500])), "doc_id long, text string").withColumn("ids", F.lit(1))
    for row in SP.digest_pieces(SP.encode_pieces(docs, MODEL)).collect():
        ids = encoder.library.encode((WEIRD[:5] + ["word " * 500])[row["doc_id"]] or "")
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in (np.array([], np.int64), np.array([0]), np.array([5, 5, 5]), np.sort(rng.integers(0, 10**12, 3000)), np.arange(2000)):
        made = TF.EliasFano.encode(values)
        again, _ = TF.EliasFano.from_bytes(b"x" + made.to_bytes(), 1)
        assert again.all().tolist() == values.tolist()
        assert [again[i] for i in range(0, len(values), 37)] == values[::37].tolist()
        some = rng.integers(0, len(values), 50) if len(values) else np.zeros(0, np.int64)
        assert again.many(some).tolist() == values[some].tolist()
    lists = [rng.integers(0, 900, n).astype("<u2") for n in (3, 0, 700, 1, 1, 5000, 0)] * 60
    block = TF.Block(TF.pack_block(list(range(len(lists))), np.cumsum([len(x) for x in lists]), b"".join(x.tobytes() for x in lists), 2))
    assert all(block.document(i).tolist() == lists[i].tolist() for i in range(len(lists)))
    index = np.array([5, 0, 6, 300])
    assert [block.ids[b:e].tolist() for b, e in zip(*block.offsets(index))] == [lists[i].tolist() for i in index]
    with pytest.raises(ValueError):
        TF.Block(TF.pack_block([1], np.array([1]), b"\1\0", 2)[:-1])


def test_token_files(spark):
    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    library = Tokenizer.from_str(definition)
    texts = [None, "", " \t", "The quick  brown FOX's 12\n3", "<|startoftext|> x", "İ Σς É é", "a b", "z" * 5000, "same", "same"]
    ids = [7, -3, 2**40, 1, 0, 5, 6, 9, 8, 8]
    docs = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, start int")
    rows = sorted(TF.read_tokens(TF.write_tokens(docs, definition, end_id=1)).collect(), key=lambda r: r["start"])
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in zip(ids, texts, strict=True)), key=lambda x: x[0])
    at = 0
    for row, (doc_id, tokens) in zip(rows, want, strict=True):
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, at, len(tokens))
        assert row["ids_crc32"] == zlib.crc32(np.array(tokens, "<u4").tobytes())
        at += len(tokens)
    assert TF.read_tokens(TF.write_tokens(docs.limit(0), definition, end_id=1)).count() == 0


def test_languages(spark, small):
    docs = spark.read.parquet(small.replace("0.001", "0.01") + "/documents.parquet")
    model = L.fit(docs)
    out = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.filter("lang = lang_pred").count() >= 0.98 * out.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "日本語"), (None, "the and of")], "doc_id long, text string").withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in L.predict(odd, model).collect()}
    assert [got[i]["lang_pred"] == "und" for i in (1, 2, 3, 4)] == [True, True, True, False] and got[None]["lang_pred"] == "en"
    none = L.fit(docs.limit(0))
    assert {r["lang_pred"] for r in L.predict(odd, none).collect()} == {"und"}


def test_languages_like_counting(spark):
    """Bits, rates and decisions by plain loops over every n-gram; the split by zlib; long, repeated and odd texts."""
    rng = np.random.default_rng(2)
    words = {lang: ["".join(rng.choice(list(abc), rng.integers(2, 8))) for _ in range(60)] for lang, abc in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "ghijké"))}
    rows = [(i, " ".join(rng.choice(words[k], rng.integers(3, 60))), k) for i, k in enumerate(list(words) * 40)] + [(500, None, "aa"), (501, "", "bb"), (502, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs)
    assert set(model.languages) == set(words)
    texts = [t for _, t, _ in rows] + ["abc " * 200_000, "Abc-DEF ghi1", "12 !", "12 !", "日本"]
    mask64 = (1 << 64) - 1
    for text, lang, score in zip(texts, *L.classify([(t or "").encode() for t in texts], model), strict=True):
        folded = bytes((b + 32 if 65 <= b <= 90 else b) if 97 <= (b | 32) <= 122 or b > 127 else 32 for b in b" " * 4 + (text or "").encode() + b" " * 4)
        if len(folded) > 10_000:
            folded = folded[:3 + 4 * 500] + b" " * 4  # a periodic text has the rates of its period, but for its ends
        counts, seen = [0] * len(model.languages), 0
        for n in L.LENGTHS:
            for i in range(len(folded) - n + 1):
                if folded[i + 1] != 32:
                    code = n
                    for b in folded[i : i + n]:
                        code = (code << 8 | b) & mask64
                    seen += 1
                    bits = mask64
                    for p in L.PROBES:
                        bits &= int(model.slots[((code ^ code >> 15) * p & mask64) >> 64 - int(len(model.slots)).bit_length() + 1, 0])
                    for k in range(len(counts)):
                        counts[k] += bits >> k & 1
        rates = [max(0.0, (c / max(seen, 1) - f) / (1 - f)) for c, f in zip(counts, model.false_positive)]
        if not any(c.isalpha() for c in text or ""):
            assert (lang, score) == ("und", 0.0)
        else:
            assert lang == model.languages[int(np.argmax(rates))] and 0 <= score <= 1
            assert abs(score - (max(rates) / sum(rates) if sum(rates) else 0)) < 1e-3
    out = L.predict(docs.union(docs.filter("doc_id < 5")), model).collect()
    assert len(out) == len(rows) + 5 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in out)


def test_batches_do_not_matter(spark, small):
    docs = spark.read.parquet(small + "/documents.parquet")
    model = L.fit(docs)
    parts = [t.encode() for t in docs.toPandas().text]
    alone = [L.classify([p], model) for p in parts[:30]]
    together = L.classify(parts[:30], model)
    assert [x[0][0] for x in alone] == together[0] and [x[1][0] for x in alone] == together[1]


