"""Personal data and the terms that reveal it, with DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  Each value found is a protected entity, and so is
what values have in common: the domain of an address, the networks of an IP address, the issuer of a card and the area of
a phone number, which occur in more documents than any one value.  A term that stands in several documents of an entity,
and hardly anywhere else in the corpus, reveals it: with p(c), p(t) and p(c, t) the shares of documents that hold entity c,
term t and both, their pointwise mutual information is compared with the entity's information content -log2 p(c), as in
Sanchez and Batet's C-sanitisation (2016).  A ratio of 1 means that whoever reads the term knows the entity.  In the
documents that hold the entity, terms over ``remove_at`` are removed and terms over ``generalise_at`` are replaced by their
class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep

_E = r"A-Za-z0-9._%+-"
#: The base kinds, in this order.  \G and the look-behind only spare starts inside a run that can't match
#: there if they don't at its start; possessive repeats can't change a match, as nothing after them could use less.
BASE = {
    "email": rf"(?:\G|(?<![{_E}]))[{_E}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a kind can't occur.
CUE = {"email": "@", "ip": ".", "phone": "+"}
_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
NOT_WORD = r"[^\p{L}\p{N}]++"
SPAN = "array<struct<kind: string, begin: int, end: int, value: string>>"
#: A table of so many terms or entities and bytes at most may be broadcast; each row counts for so many bytes and its strings.
SMALL_ROWS, SMALL_BYTES, ROW_BYTES = 200_000, 16 << 20, 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + weighed(i))
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


CHECK = {
    "email": None,
    "ip": lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def levels(span: Column) -> Column:
    """The entities that a span stands for: its value and what it has in common with others."""
    value = F.lower(span["value"])
    digits, parts = _digits(value), F.split(value, r"\.")
    common = (
        F.when(span["kind"] == "email", F.array(F.concat(F.lit("domain:"), F.substring_index(value, "@", -1))))
        .when(span["kind"] == "ip", F.array(F.concat(F.lit("network:"), F.array_join(F.slice(parts, 1, 3), ".")), F.concat(F.lit("network:"), F.array_join(F.slice(parts, 1, 2), "."))))
        .when(span["kind"] == "card", F.array(F.concat(F.lit("issuer:"), F.substring(digits, 1, 6))))
        .otherwise(F.array(F.concat(F.lit("area:"), F.substring(digits, 1, 4))))
    )
    return F.concat(F.array(F.concat(span["kind"], F.lit(":"), value)), common)


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


#: Elements that a running aggregate goes through at once, and code points of a piece of text: what is copied stays short.
RUN, PIECE = 256, 64


def running(values: Column, combine) -> Column:
    """The inclusive running sum or maximum of whole numbers from 0 up: within stretches, and over the stretches' totals."""
    zero = F.lit(0)
    go = lambda part, start: F.aggregate(part, F.array(start), lambda out, x: F.concat(out, F.array(combine(F.element_at(out, -1), x))))
    cut = lambda v: F.transform(F.sequence(zero, F.ceil(F.size(v) / RUN).cast("int") - 1), lambda b: F.slice(v, b * RUN + 1, F.lit(RUN)))
    totals = lambda parts: F.transform(parts, lambda p: F.aggregate(p, zero, combine))
    within = lambda parts: F.flatten(F.zip_with(parts, F.slice(go(totals(parts), zero), F.lit(1), F.size(parts)), lambda p, start: F.slice(go(p, start), F.lit(2), F.lit(RUN))))
    return let(values, lambda v: F.when(F.size(v) > 0, let(cut(v), within)).otherwise(F.array().cast("array<int>")))


def place(text: Column, matches: Column, pattern: Column, kind: str) -> Column:
    """Spans of the matches of a pattern, from the lengths of the gaps between them and their own."""
    lengths = F.flatten(F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches, lambda g, m: F.array(F.length(g), F.length(m))))
    span = lambda at: lambda m, i: F.struct(F.lit(kind).alias("kind"), F.get(at, 2 * i).alias("begin"), F.get(at, 2 * i + 1).alias("end"), m.alias("value"))
    spans = let(matches, lambda found: let(running(lengths, lambda a, b: a + b), lambda at: F.transform(found, span(at))))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(SPAN))


def rebuilt(text: Column, spans: Column, put) -> Column:
    """The text with each span replaced by ``put(span, covered)``; ``covered``: up to where earlier spans reach."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))

    def piece(pieces: Column, begin: Column, end: Column) -> Column:
        first = F.floor(begin / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1), "")
        return F.when(end > begin, F.substring(some, begin % PIECE + 1, end - begin)).otherwise("")

    def whole(own: Column, reach: Column, pieces: Column) -> Column:
        part = lambda s, before: F.concat(piece(pieces, before, s["begin"]), put(s, before))
        parts = F.transform(own, lambda s, i: part(s, F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1))))
        return F.concat(F.array_join(parts, ""), piece(pieces, F.element_at(reach, -1), F.length(text)))

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    out = let(ordered, lambda own: let(running(F.transform(own, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), lambda reach: let(pieces, lambda cut: whole(own, reach, cut))))
    return F.when(F.size(spans) > 0, out).otherwise(text)


def masked(text: Column, spans: Column) -> Column:
    """The text with NUL for each character of a span, so that everything stays where it is."""
    return rebuilt(text, spans, lambda s, covered: F.repeat(F.lit("\0"), F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], covered))))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced: base kinds and generalised terms by their class, removed terms by nothing."""

    def put(s: Column, covered: Column) -> Column:
        word = F.when(s["value"].rlike(r"^\p{N}+$"), "[NUMBER]").when(s["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        own = F.when(s["kind"] == "term", "").when(s["kind"] == "general", word).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.when(s["begin"] >= covered, own).otherwise("")

    return rebuilt(text, spans, put)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``found``: the base spans with their values, by start and then in the order of the kinds."""
    body = F.col(text)
    found = {}
    for kind, pattern in BASE.items():
        all_of = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        found[f"_{kind}"] = F.when(F.contains(body, F.lit(CUE[kind])), all_of).otherwise(F.array().cast("array<string>")) if kind in CUE else all_of
    rows = docs.withColumns(found)
    spans = {}
    for kind, pattern in BASE.items():
        own = place(body, F.col(f"_{kind}"), F.lit(pattern), kind)
        spans[f"_{kind}"] = F.filter(own, _tester(CHECK[kind])) if CHECK[kind] else own
    rows = rows.withColumns(spans)
    rank = {k: i for i, k in enumerate(BASE)}
    order = F.create_map(*[F.lit(x) for k in rank for x in (k, rank[k])])
    merged = F.transform(F.concat(*[F.col(f"_{k}") for k in BASE]), lambda s: F.struct(s["begin"].alias("begin"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    ordered = F.transform(F.array_sort(merged), lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), s["value"].alias("value")))
    return rows.withColumn("found", ordered).drop(*[f"_{k}" for k in BASE])


def _tester(check):
    return lambda s: check(s["value"])


def _words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != ""))


def _fold(text: Column) -> Column:
    """Equal for texts that match each other whatever the case, as patterns with (?iu) compare letters."""
    return F.upper(F.translate(text, "\u0130\u212a\u1e9e\u212b\u2126\u03f4", "ikßåωθ"))


def _folded_words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(_fold(F.array_join(F.split(text, NOT_WORD), " ")), " "), lambda w: w != ""))


def _small(df: DataFrame) -> bool:
    """Whether a kept table of strings and numbers may be broadcast."""
    strings = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(sum(strings, F.lit(ROW_BYTES))), F.lit(0))).first()
    return n <= SMALL_ROWS and size <= SMALL_BYTES


def _at_hand(df: DataFrame) -> DataFrame:
    """A kept table, to be broadcast if it is small; Spark goes by the size of its files, which may be a small part of its rows'."""
    return F.broadcast(df) if _small(df) else df.hint("merge")


def _bodies(found: DataFrame, *columns: str) -> DataFrame:
    """Equal texts hold the same entities and words: one row that counts as often as the text occurs."""
    return found.filter(F.size("entities") > 0).groupBy("body").agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in columns])


def disclosing_terms(docs: DataFrame, found: DataFrame, text: str, min_support: int, remove_at: float, generalise_at: float) -> DataFrame:
    """``entity, removed, generalised``: the terms of the corpus that reveal each entity, as lists."""
    rated, _ = rated_terms(docs, found, text, min_support, generalise_at)
    pick = lambda test: F.sort_array(F.collect_set(F.when(test, F.col("term"))))
    return rated.groupBy("entity").agg(pick(F.col("ratio") >= remove_at).alias("removed"), pick(F.col("ratio") < remove_at).alias("generalised"))


def rated_terms(docs: DataFrame, found: DataFrame, text: str, min_support: int, generalise_at: float) -> tuple[DataFrame, DataFrame]:
    """``entity, term, ratio``: the terms of the corpus that reveal each entity; and ``body, entity``: which texts hold which
    entities of ``min_support`` documents.

    ``found`` has a row for each document: ``body``, equal for equal texts only, its ``entities`` and, if it has any, its
    ``words``.  All counts are of whole documents.  With N documents a ratio is 1 + log2(n_both / n_term) / log2(N /
    n_entity), and n_both is at most n_entity, so no term in more than n_entity ** g * N ** (1 - g) documents reaches a
    ratio of g.  What this bound and ``min_support`` rule out is left out before terms and entities are paired.
    """
    n_docs = F.lit(float(max(found.count(), 1)))
    bodies = _bodies(found, "entities", "words")
    holds = bodies.select("body", "times", F.explode("entities").alias("entity"))
    of_entity = holds.groupBy("entity").agg(F.sum("times").alias("n_entity")).filter(F.col("n_entity") >= min_support)
    # A little more than the bound, for rounding.
    most = F.pow(F.col("n_entity"), F.lit(float(generalise_at))) * F.pow(n_docs, F.lit(1.0 - generalise_at)) * 1.000001
    holds = keep(holds.join(_at_hand(keep(of_entity.withColumn("most", most), "of_entity")), "entity"), "holds")
    bounds = holds.groupBy("body").agg(F.max("most").alias("most"))
    has = keep(bodies.join(bounds, "body").select("body", "times", "most", F.explode("words").alias("term")), "has")
    # In documents of entities a term is no more frequent than in all.
    terms = has.groupBy("term").agg(F.sum("times").alias("n"), F.max("most").alias("most")).filter((F.col("n") >= min_support) & (F.col("n") <= F.col("most")))
    terms = keep(terms.select("term", "most"), "terms")
    words = docs.select(F.explode(_words(F.col(text))).alias("term"))
    if _small(terms):
        of_term = words.join(F.broadcast(terms), "term").groupBy("term", "most").agg(F.count("*").alias("n_term"))
    else:
        of_term = words.groupBy("term").agg(F.count("*").alias("n_term")).join(terms.hint("merge"), "term")
    of_term = _at_hand(keep(of_term.filter(F.col("n_term") <= F.col("most")).select("term", "n_term"), "of_term"))
    rare = has.join(of_term, "term").filter(F.col("n_term") <= F.col("most")).select("body", "term", "n_term")
    pairs = holds.join(rare, "body").filter(F.col("n_term") <= F.col("most"))
    pairs = pairs.groupBy("entity", "n_entity", "term", "n_term").agg(F.sum("times").alias("n_both")).filter(F.col("n_both") >= min_support)
    information = -F.log2(F.col("n_entity") / n_docs)
    mutual = F.log2(F.col("n_both") * n_docs / (F.col("n_entity") * F.col("n_term")))
    rated = pairs.withColumn("ratio", F.when(information > 0, mutual / information).otherwise(0.0)).filter(F.col("ratio") >= generalise_at)
    return rated.select("entity", "term", "ratio"), holds.select("body", "entity")


def terms_of_texts(found: DataFrame, holds: DataFrame, rated: DataFrame, remove_at: float) -> DataFrame:
    """``body, removed, generalised``: of the terms that reveal an entity of a text, those that the text may hold.

    What an entity's terms are grows with its documents, so a text isn't given all of them: they meet its own ``folded``
    words by entity and word.  ``rated`` is kept, and has the folded ``term`` as ``fold``.  Words are of letters and digits, so
    a term that a pattern would find with U+0345, no letter, for an iota is left.
    """
    seen = _bodies(found, "folded").select("body", F.explode("folded").alias("fold"))
    seen = seen.join(_at_hand(keep(rated.select("fold").distinct(), "folds")), "fold", "left_semi")
    held = holds.join(_at_hand(keep(rated.select("entity").distinct(), "risky")), "entity", "left_semi")
    own = seen.join(held.hint("merge"), "body").join(_at_hand(rated), ["entity", "fold"])
    own = own.groupBy("body", "term").agg(F.max("ratio").alias("ratio"))
    pick = lambda test: F.collect_list(F.when(test, F.col("term")))
    return own.groupBy("body").agg(pick(F.col("ratio") >= remove_at).alias("removed"), pick(F.col("ratio") < remove_at).alias("generalised"))


def _terms_pattern(terms: Column) -> Column:
    return F.concat(F.lit(r"(?<![\p{L}\p{N}])(?iu:"), F.array_join(terms, "|"), F.lit(r")(?![\p{L}\p{N}])"))


def find_private(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_support: int = 3, remove_at: float = 0.97, generalise_at: float = 0.85, returned=lambda text: text) -> DataFrame:
    """``doc_id, found, terms, sanitised`` for every row: base spans and disclosing terms as (kind, begin, end, value), in
    code points, and ``returned`` (by default all) of the text without them.

    Null and empty texts have no spans.  Texts are searched whole, in time proportional to their length and spans.  Every
    word of every document that holds an entity may be a term of it, however far from the entity; terms are looked for in
    all documents that hold the entity, outside of base spans; documents without personal data are left alone.  Entity
    and term must occur together in ``min_support`` documents: an entity in fewer documents has its own spans, and what
    it has in common with others may have terms.  With 1 as ``min_support`` each word that stands in one document only
    has a ratio of 1 to each entity there and is removed.  Repeated rows count as documents of their own and get the same
    spans.  An empty table gives no rows; other columns are not read, so their names can't clash.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    entities = F.array_distinct(F.flatten(F.transform("found", levels)))
    some = F.size("found") > 0
    if_some = {"words": _words(F.col("text")), "folded": _folded_words(masked(F.col("text"), F.col("found"))), "text": F.col("text")}
    found = base_spans(rows).select("doc_id", F.unhex(F.md5("text")).alias("body"), "found", entities.alias("entities"), *[F.when(some, c).alias(k) for k, c in if_some.items()], returned(F.when(some, sanitised(F.col("text"), F.col("found"))).otherwise(F.col("text"))).alias("sanitised"))
    found = keep(found, "found")
    rated, holds = rated_terms(rows, found, "text", min_support, generalise_at)
    rated = keep(rated.withColumn("fold", _fold(F.col("term"))), "rated")
    wanted = keep(terms_of_texts(found, holds, rated, remove_at), "wanted")
    # Documents with spans carry their texts to their terms; no others are shuffled.
    hit = found.filter(some).join(wanted.hint("merge"), "body", "left")
    hit = hit.withColumn("masked", F.when(F.col("removed").isNotNull(), masked(F.col("text"), F.col("found"))))
    spans = []
    for kind in ("removed", "generalised"):
        pattern = _terms_pattern(F.col(kind))
        matches = F.when(F.size(kind) > 0, F.regexp_extract_all("masked", pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
        hit = hit.withColumn(f"_{kind}", matches)
        spans.append(place(F.col("masked"), F.col(f"_{kind}"), pattern, "term" if kind == "removed" else "general"))
    hit = hit.select("doc_id", "text", "found", F.concat(*spans).alias("terms"), "sanitised")
    less = F.when(F.size("terms") > 0, returned(sanitised(F.col("text"), F.concat("found", "terms")))).otherwise(F.col("sanitised"))
    hit = hit.select("doc_id", "found", "terms", less.alias("sanitised"))
    return hit.unionByName(found.filter(~some).select("doc_id", "found", F.array().cast(SPAN).alias("terms"), "sanitised"))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    found = find_private(spark.read.parquet(f"{sf_dir}/documents.parquet"), returned=lambda text: F.sha2(text, 256))
    show = lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    rank = F.create_map(*[F.lit(x) for i, k in enumerate((*BASE, "term", "general")) for x in (k, i)])
    every = F.array_sort(F.transform(F.concat("found", "terms"), lambda s: F.struct(s["begin"].alias("begin"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(F.array_join(F.transform("found", show), ","), 256).alias("base_sha256"), F.array_join(F.transform(every, show), ",").alias("spans"), F.col("sanitised").alias("sanitised_sha256"))
