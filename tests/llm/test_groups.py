"""Deduplication, components, archives, mixing and the pipeline against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from comparing import connect, same_rows
from lodestrata.llm import embedding_dedup as ED
from lodestrata.llm import exact_dedup as XD
from lodestrata.llm import minhash_dedup as MD
from lodestrata.llm import mixing as MX
from lodestrata.llm import registry
from lodestrata.llm import warc as W
from lodestrata.llm.components import components
from lodestrata.llm.shared import new_path


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, small, name):
    same_rows(registry.queries()[name](spark, small), connect(small), registry.oracle_sql()[name])


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_cuckoo_index():
    """Against a dict: insertions, copies, deletions, and growth from stored keys; equal fingerprints don't merge."""
    rng = np.random.default_rng(3)
    keys = [hashlib.sha256(str(i % 3000).encode()).digest() for i in range(6000)]
    index, want = XD.CuckooIndex(8), {}
    for i, k in enumerate(keys):
        index.add(k, 5, i, 1)
        old = want.get(k, (0, -1))
        want[k] = (old[0] + 1, max(old[1], i))
        if rng.random() < 0.3:
            gone = keys[rng.integers(0, i + 1)]
            assert index.remove(gone, 5) == (gone in want)
            want.pop(gone, None)
    assert {e[0]: (e[3], e[2]) for e in index} == want and len(index) == len(want)
    twin = bytes(16) + b"a" * 16, bytes(16) + b"b" * 16  # same buckets and fingerprint
    pair = XD.CuckooIndex()
    pair.add(twin[0], 1, 1, 1)
    assert pair.get(twin[1], 1) is None and pair.get(twin[0], 2) is None
    for i in range(40):  # more equal fingerprints than two buckets hold
        full = XD.CuckooIndex() if i == 0 else full
        try:
            full.add(bytes(8) + bytes([i, 1]) + bytes(22), 1, i, 1)
        except RecursionError:
            raise AssertionError("growth doesn't end") from None


def test_exact_copies(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "a"), (6, "x" * 100_000), (7, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(0))
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in XD.find_copies(docs).collect()), key=str)
    want = [(1, 2, 3, False), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 2, True), (5, 5, 2, True), (6, 7, 2, False), (7, 7, 2, True), (None, 2, 3, False)]
    assert got == sorted(want, key=str)
    assert XD.find_copies(docs.limit(0)).count() == 0


def test_contents_are_verified(spark):
    """Two texts that are given one digest stop the job."""
    groups = spark.createDataFrame([(b"d", 1, 2, 2), (b"e", 1, 3, 1)], XD.GROUPS)
    contents = lambda *texts: spark.createDataFrame([(b"d", t) for t in texts] + [(b"e", "z")], "digest binary, content string")
    assert XD.verified(groups, contents("a", "a")).count() == 2
    with pytest.raises(Exception, match="one digest"):
        XD.verified(groups, contents("a", "b")).collect()


def test_index_updates(spark):
    keys = lambda rows: XD.content_keys(spark.createDataFrame(rows, "doc_id long, text string"))
    index = XD.build_index(keys([(1, "a"), (2, "b"), (3, "a")]))
    after = XD.update_index(index, keys([(4, "c"), (5, "b")]), keys([(0, "a"), (0, "unknown")]))
    assert sorted((r["keep_id"], r["n"]) for r in after.collect()) == [(4, 1), (5, 2)]


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == union_find({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_like_brute_force(spark):
    """Chains of edits, a hub with many near copies, exact copies, short, empty and null texts."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n ", "one two", "ONE  two", "one two three four five", "É x", "é x"]
    for n in (30, 60, 150):
        base = list(rng.choice(words, n))
        for k in range(40):
            copy = list(base)
            for j in rng.integers(0, n, k % 4):
                copy[j] = str(rng.choice(words))
            texts.append(" ".join(copy))
            if k % 10 == 0:
                base = copy
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("tile", F.lit(1))
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = union_find(range(len(sets)), links)
    for size in (MD.TILE_ROWS, 7):  # small tiles: groups are cut and still meet
        MD.TILE_ROWS, old = size, MD.TILE_ROWS
        try:
            rows = MD.near_copies(docs).collect()
        finally:
            MD.TILE_ROWS = old
        assert {r["doc_id"]: r["component_id"] for r in rows} == want
        assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in rows)
    assert MD.near_copies(docs.limit(0)).count() == 0


def test_near_vectors_like_brute_force(spark):
    rng = np.random.default_rng(8)
    hub = rng.standard_normal(16)
    vectors = [hub + rng.standard_normal(16) * s for s in np.linspace(0, 0.5, 80)] + [rng.standard_normal(16) for _ in range(60)] + [hub * 3, hub * 1e30, hub * 1e-30]
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(vectors)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [None] * 16, 0), (904, [float("nan")] * 16, 0), (905, [float("inf")] * 16, 0), (906, rows[0][1], None), (907, [1.0, 2.0], 0), (None, rows[0][1], 0), (908, rows[0][1], 0), (909, rows[0][1], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("tile", F.lit(1))
    good = {i: (np.array(v) / np.abs(v).max(), lab) for i, v, lab in rows + [odd[-1], odd[-2], odd[7]]}
    links = [(i, j) for i in good for j in good if i < j and good[i][1] == good[j][1] and len(good[i][0]) == len(good[j][0]) and good[i][0] @ good[j][0] / np.linalg.norm(good[i][0]) / np.linalg.norm(good[j][0]) >= 0.93]
    want = union_find([r[0] for r in rows + odd if r[0] is not None], links)
    counts = {i: sum(i in e for e in links) for i in want}
    for size in (ED.TILE_ROWS, 9):
        ED.TILE_ROWS, old = size, ED.TILE_ROWS
        try:
            got = ED.near_vectors(frame).collect()
        finally:
            ED.TILE_ROWS = old
        assert len(got) == len(rows + odd)
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None} == {i: (counts[i], want[i]) for i in want}
    assert ED.near_vectors(frame.limit(0)).count() == 0


def test_archives(spark):
    tricky = "x" * 90 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a/b?c\r\nX: y", "é" * 60), (2, None, "é" * 60), (3, "http://a", tricky), (4, "u", tricky), (5, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (9, "u", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("type", F.lit(1))
    path = new_path(spark, "warc")
    got = {r["page_id"]: tuple(r)[1:] for r in W.archive_pages(pages, path).collect()}
    first = {}
    for i, _, html in rows:
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        held = first.setdefault(digest, i) if len(body) >= 100 else i
        assert got[i] == (len(body), digest, "response" if held == i else "revisit", None if held == i else held)
    captures = W.assemble(W.read_archives(spark, path)).collect()
    assert len(captures) == len(rows) and all(c["request"] and c["metadata"] for c in captures)
    bodies = {bytes(c["response"]["content"]) for c in captures if c["response"]["type"] == "response"}
    assert bodies == {(h or "").encode() for _, _, h in rows}
    assert W.archive_pages(pages.limit(0), new_path(spark, "warc")).count() == 0
    with pytest.raises(ValueError, match="torn"):
        list(W.walk(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", True))


def test_archives_of_odd_pages(spark, monkeypatch):
    """Repeated rows, rows of one id that differ, null ids and long pages in small files; each record is a gzip member."""
    import gzip
    import random

    monkeypatch.setattr(W, "FILE_BYTES", 20_000)
    noise = random.Random(1)
    long = "".join(chr(noise.randrange(32, 1000)) for _ in range(300_000))
    rows = [(1, "u", "same " * 50)] * 3 + [(2, "u", "same " * 50)] * 2 + [(3, "a", "x"), (3, "b", "y"), (3, "a", "x"), (None, "u", "z"), (None, "u", "same " * 50)] + [(10 + i, "u", long + str(i)) for i in range(3)]
    path = new_path(spark, "warc")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in W.archive_pages(pages.coalesce(1), path).collect()), key=str)
    want = [(i, len(h.encode()), "revisit" if i != 1 and h.startswith("same") else "response", 1 if i != 1 and h.startswith("same") else None) for i, _, h in rows]
    assert got == sorted(want, key=str)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()]
    assert len(files) > 3
    for data in files:
        records = list(W.members(memoryview(data)))
        assert b"".join(records) == gzip.decompress(data) and all(m.startswith(b"WARC/") and m.endswith(b"\r\n\r\n") for m in records if m)


def test_long_http_heads():
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"X-{i}: {'y' * 100}\r\n" for i in range(1000)) + "\r\n"
    block = (head + "payload").encode()
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    (row,) = W.walk(record, True)
    assert len(head) > 100_000 and row[-1] == b"payload" and row[9] == 7


def test_targets():
    assert MX.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert MX.targets([10, 100], [5, 1]) == [30.0, 80.0]
    assert MX.targets([0, 0], [5, 2]) == [0.0, 0.0] and MX.targets([], []) == []
    capped = MX.targets([1, 1, 1, 97], [5, 2, 1, 5])
    assert capped[:3] == [3.0, 3.0, 3.0] and abs(sum(capped) - 100) < 1e-9


def test_permutations():
    for n in (1, 2, 3, 17, 256, 1000):
        index = np.arange(n)
        out = MX.permute(index, np.full(n, n), np.full(n, 99))
        assert sorted(out.tolist()) == index.tolist()


MIXED_SOURCES = ["a", "b", "c", None]


def mixed_docs(spark):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join([f"w{j}" for j in range(int(rng.integers(0, 400)))]), MIXED_SOURCES[i % 4] if i else "tiny") for i in range(400)]
    rows += [(1000, None, "a"), (1001, "x " * 30_000, "b"), (5, "again and again", "a"), (None, "no id at all", "a"), (None, "no id at all", "a")]
    rows += [(2000 + i, f"few {i}\nwords", f"small{i}") for i in range(30)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("s", F.lit(1))


def test_mix(spark):
    rows, docs = mixed_docs(spark)
    plan = MX.mix(docs)
    taken = plan.taken().collect()
    assert len(taken) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in taken)
    # Sizes and targets by another way: DuckDB's sizes, and shares by bisection of the level at which sources stop.
    import duckdb
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"])  # noqa: F841
    sizes = dict(duckdb.sql(r"select source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) from frame group by source").fetchall())
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weigh = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    low, high = 0.0, float(sum(sizes.values()))
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * sizes[n], level * weigh[n]) for n in names) < sum(sizes.values()) else (low, level)
    assert {s.name: s.size for s in plan.sources} == sizes
    assert all(abs(s.target - min(3 * sizes[s.name], level * weigh[s.name])) < 1e-6 * max(1, s.target) for s in plan.sources)
    for s in plan.sources:
        got = sum(r["taken"] for r in taken if r["source_size"] == s.size and r["target"] == s.target)
        same = sum(t.size == s.size and t.target == s.target for t in plan.sources)
        assert got == same * round(s.target)
    again = MX.mix(docs.repartition(7)).taken().collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))
    # What is taken of each document, counted word by word over the slots of the mix.
    placed, words = plan.documents.collect(), {}
    stream = {(d["s"], d["begin"] + i): d["begin"] for d in placed for i in range(d["size"])}
    for slot in plan.slots.collect():
        for at in range(slot["block"] * MX.BLOCK_WORDS, slot["block"] * MX.BLOCK_WORDS + slot["limit"]):
            if (slot["s"], at) in stream:
                key = slot["s"], stream[slot["s"], at]
                words[key] = words.get(key, 0) + 1
    want = Counter((d["doc_id"], d["size"], words.get((d["s"], d["begin"]), 0) if d["size"] else 0) for d in placed)
    assert want == Counter((r["doc_id"], r["size"], r["taken"]) for r in taken)
    slots = plan.blocks().collect()
    assert sum(p["words"] for b in slots for p in b["parts"]) == sum(r["taken"] for r in taken)
    assert MX.mix(docs.limit(0)).taken().count() == 0


def test_mixed_rows(spark):
    """The rows of the mix have the words of each source's target, each a run of its document's own text."""
    rows, docs = mixed_docs(spark)
    out = MX.mixed_rows(docs.withColumn("n_chars", F.length("text").cast("int")), length="n_chars")
    assert out.columns == [*docs.columns, "n_chars"]
    got, texts, found = out.collect(), {}, {}
    for i, t, s in rows:
        texts.setdefault((i, s), []).append(t)
    for r in got:
        assert any(t and r["text"] in t for t in texts[r["doc_id"], r["source"]]) and r["n_chars"] == len(r["text"])
        found[r["source"]] = found.get(r["source"], 0) + len(r["text"].split())
    assert found == {s.name: s.words for s in MX.mix(docs).sources if s.words}
    assert any(r["doc_id"] is None for r in got)
    assert MX.mixed_rows(docs.limit(0)).count() == 0


def test_shards_of_many_slots(spark):
    """Two thousand million slots are drawn without data: every slot of a source has one shard."""
    sources = [MX.Source("a", 10**12, 1.9e12), MX.Source("b", 5 * 10**11, 1e11), MX.Source("c", 100, 50.0)]
    assert sum(s.slots for s in sources) > 15e9
    rows = MX.plan_shards(spark, sources, 7, shard_slots=1 << 22).collect()
    for i, s in enumerate(sources):
        own = sorted((r["first"], r["n"], r["part"]) for r in rows if r["s"] == i)
        assert sum(n for _, n, _ in own) == s.slots and all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:]))
        assert [p for *_, p in own] == sorted({p for *_, p in own})
    sizes = Counter()
    for r in rows:
        sizes[r["part"]] += r["n"]
    assert max(sizes.values()) < 1.02 * (1 << 22)
    assert sorted(map(str, rows)) == sorted(map(str, MX.plan_shards(spark, sources, 7, shard_slots=1 << 22).collect()))


def test_each_pass_takes_each_block_once():
    for size, words in ((1000, 2500), (128, 300), (100, 250), (1280, 1279), (5000, 5000), (7, 3), (130, 129)):
        source = MX.Source("x", size, float(words))
        k = np.arange(source.slots)
        block, limit = MX.block_and_limit(k, np.full(len(k), size), np.full(len(k), words), np.zeros(len(k), np.int64), 3)
        assert sum(min(n, size - b * MX.BLOCK_WORDS) for b, n in zip(block.tolist(), limit.tolist())) == words
        for p in range(source.passes):
            assert sorted(block[p * source.blocks : (p + 1) * source.blocks].tolist()) == list(range(source.blocks))
        assert len(set(block[source.passes * source.blocks :].tolist())) == source.slots - source.passes * source.blocks


def test_language_stage_drops_unseen_scripts(spark, small):
    """Scripts that the model hasn't seen have letters but no recognisable language; op9 itself still names one."""
    import corpus_pipeline as CP
    from lodestrata.llm import language_id as L

    docs = spark.read.parquet(f"{small}/documents.parquet")
    unseen = [(10**6, "日本語の文章です", "en", "a", 8), (10**6 + 1, "Привет как дела", None, "a", 15), (10**6 + 2, "ქართული ენა", None, "a", 11)]
    more = docs.union(spark.createDataFrame(unseen, docs.schema))
    model = L.fit(docs)
    judged = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(more, model).filter(f"doc_id >= {10**6}").collect()}
    assert all(lang != L.UNKNOWN and score == 0 for lang, score in judged.values()), judged
    kept = [r["doc_id"] for r in CP.language_stage(spark, more, small).select("doc_id").collect()]
    assert not set(kept) & {r[0] for r in unseen} and set(kept) == {r["doc_id"] for r in CP.language_stage(spark, docs, small).collect()}


def test_pipeline(spark, small):
    """The stages against their operators on each stage's own input, and the whole run twice."""
    import corpus_pipeline as CP

    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, "src1", 0), (10**6 + 1, "12 !", "en", None, 4)], docs.schema)
    docs = docs.union(extra)
    kept = CP.language_stage(spark, docs, small)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    exact = CP.exact_stage(spark, kept, small)
    texts = {}
    for r in kept.collect():
        texts[r["text"]] = max(r["doc_id"], texts.get(r["text"], -1))
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(texts.values())
    near = CP.near_stage(spark, exact, small)
    assert near.count() == MD.near_copies(exact).filter("kept").count() and near.columns == docs.columns
    mixed = CP.mixing_stage(spark, near, small)
    assert mixed.columns == docs.columns and set(r["doc_id"] for r in mixed.collect()) <= set(r["doc_id"] for r in near.collect())
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(MX.WORD))).alias("n")).collect()}
    assert words == {s.name: s.words for s in MX.mix(near).sources if s.words}
    out = CP.run(spark, small)
    assert out.filter("not round_trip").count() == 0 and out.count() == CP.run(spark, small).count() > 0


def test_pipeline_edges(spark, small):
    """Rows without an id, repeated ids and rows, a source without a name, columns with the stages' own names; no rows."""
    import corpus_pipeline as CP

    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = docs.filter("lang = 'en' and n_chars > 300").orderBy("doc_id").first()["text"]
    odd = [(None, text + " and of the one", "en", "a", 1), (None, text + " and of the one", "en", "a", 1), (7, "the and of " + text[50:], "en", None, 1), (7, "of the end " + text[90:], "en", None, 1), (10**7, text, "en", "a", 1), (10**7, text, "en", "a", 1)]
    frame = docs.union(spark.createDataFrame(odd, docs.schema))
    for name in ("_language", "_key", "_words", "_times", "tile", "s", "block", "size", "row_key"):
        frame = frame.withColumn(name, F.lit("x"))
    for rows in (frame, frame.limit(0)):
        now = rows
        for name, stage in CP.STAGES[:-1]:
            was, now = now.count(), CP.keep(stage(spark, now, small), name)
            assert now.columns == rows.columns and now.count() <= (3 if name == "mixing" else 1) * was + 10**4
            if name != "mixing" and was:
                assert now.filter("doc_id is null").count() == 2  # never dropped as copies
        assert CP.STAGES[-1][1](spark, now, small).count() == now.count()
    assert now.count() == 0


def thue_morse(n, swap=False):
    """A word of 2 ** n letters that sums over letters modulo 2 ** 64 can't tell from its complement."""
    word = "b" if swap else "a"
    for _ in range(n):
        word += word.translate({97: 98, 98: 97})
    return word


def test_words_that_collide_in_sums_over_letters(spark):
    one, other = thue_morse(11), thue_morse(11, True)
    texts = [one, other, f"{one} b c d e f", f"{other} b c d e f", "", "A\tb\rc", "a b c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in MD.near_copies(rows).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5}


def test_very_long_texts_near_one_another(spark):
    """Texts of a million words, one changed in a hundredth of them."""
    words = [f"w{i % 9973}x{i // 7}" for i in range(1_000_000)]
    changed = words.copy()
    changed[::600] = ["new"] * len(changed[::600])
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[::-1]))], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in MD.near_copies(rows).collect()} == {1: 1, 2: 1, 3: 3}


def test_shards_follow_the_draw(spark):
    """Small mixes too have many shards; each slot's shard is the drawn one, and another seed draws and places anew."""
    rows, docs = mixed_docs(spark)
    plan, other = MX.mix(docs), MX.mix(docs, seed=8)
    slots = plan.slots.collect()
    shards = MX.shards_of(sum(s.slots for s in plan.sources))
    assert 16 < shards == len({r["shard"] for r in slots})
    drawn = {(r["s"], r["part"]): r["n"] for r in MX.plan_shards(spark, plan.sources, 7).collect()}
    assert Counter((r["s"], r["shard"]) for r in slots) == Counter(drawn)
    assert Counter((r["s"], r["shard"]) for r in other.slots.collect()) != Counter(drawn)
    first, second = ({(r["doc_id"], r["size"]): r["places"] for r in p.taken().collect()} for p in (plan, other))
    assert sum(first[k] != second[k] for k in first) > len(first) / 2 and all(p == 0 for (_, n), p in first.items() if not n)
    assert [MX.shards_of(n) for n in (0, 15, 16, 320, 10**4, 10**7)] == [1, 1, 1, 20, 64, 153]


def test_a_row_with_a_third_of_all_copies(spark, monkeypatch):
    """Copies of a row stand side by side; each is a document with a place of its own."""
    monkeypatch.setattr(MX, "CHUNK_SLOTS", 100)
    rows = [(None, "the same words again", "a")] * 3000 + [(i, f"text {i} of the others", "ab"[i % 2]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = MX.mix(docs)
    taken = plan.taken().collect()
    assert len(taken) == 6000 and sum(r["doc_id"] is None for r in taken) == 3000
    spans = sorted((r["s"], r["begin"], r["size"]) for r in plan.documents.collect())
    assert all(a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:]) if a[0] == b[0])
    assert sum(r["taken"] for r in taken) == sum(s.words for s in plan.sources)
