"""Personal data: patterns, and terms that give away whom they belong to.

Four base kinds are found by patterns and checks (email, ip, card, phone). Each
distinct value found is a protected entity. Terms are runs of three letters at
least, lower-cased, outside e-mail addresses. How much a term t
reveals of an entity c is estimated from the corpus, over all documents:

    disclosure(c, t) = PMI(c; t) / IC(c)
    PMI(c; t) = log(N n(c,t) / (n(c) n(t))),   IC(c) = log(N / n(c))

where N counts the documents, n(c) those that hold c, n(t) those that hold t,
and n(c,t) those in which t stands in the context of c: among the nearest
``CONTEXT_WORDS`` words within ``CONTEXT_CHARS`` code points on either side, up to the next
match of the kind's pattern. Since n(c,t) <= n(t) the disclosure is at most 1:
all that there is to know of c. Two documents of equal text
are no evidence of each other, so entity and pair must occur in two different texts.

A term in the context of an entity is sanitised in that document, wherever it
stands there: generalised to its shape (name or word) from
``GENERALISE`` on, removed from ``REMOVE`` on. These are the added spans, of kind ``term``.

Everything is DataFrame functions. Matches are located by their lengths and
those of the gaps between them, summed in blocks, so a text of many matches
costs no square of their number. The patterns here find the same matches as
the plain ones in ``PLAIN``, but are possessive and start where a run starts,
so that long runs cost no square either. Contexts, counts and terms are
joined by (entity, term) and by (document, term), never entity by entity.

Null and empty texts hold nothing. Rows of equal id and text get the same result
each; a null id is an id like any other. A very long text costs time and memory in
proportion to it, and most if it holds many matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import id_and_text, materialize, new_run_folder, read

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The patterns as they are stated.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The same matches without going back: a run is entered at its start, or where the last match ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PLAIN["phone"],
}
# Letters only: outside e-mail addresses no term overlaps a base span.
WORD = r"\p{L}{3,}"

CONTEXT_CHARS, CONTEXT_WORDS = 120, 8
GENERALISE, REMOVE = 0.6, 0.9
MIN_CARD, MAX_CARD, MIN_PHONE, MAX_PHONE = 16, 19, 8, 15
#: Matches of a text whose lengths are summed in one go.
BLOCK = 256

_SPANS = "array<struct<start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, pattern: str) -> Column:
    """Matches from left to right: their text, their length, and the texts before and after them (between matches)."""

    def joined(gaps: Column) -> Column:
        after = F.slice(gaps, 2, F.size(gaps))
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        sides = F.zip_with(gaps, after, lambda a, b: F.struct(a.alias("before"), b.alias("after")))
        return F.filter(
            F.zip_with(found, sides, lambda m, s: F.struct(
                m.alias("value"), F.length(m).alias("n"), F.length(s["before"]).alias("gap"), s["before"].alias("before"), s["after"].alias("after"),
            )), lambda x: x["n"].isNotNull(),
        )

    return let(F.split(text, pattern, -1), joined)


def _placed(matches: Column, keep: Callable[[Column], Column], kind: str) -> Column:
    """``keep`` of each match, with ``start`` and ``end``: running sums within blocks, on top of the sums of earlier blocks."""

    def in_block(block: Column, begin: Column) -> Column:
        def step(held: Column, m: Column) -> Column:
            start = held["at"] + m["gap"]
            one = F.struct(start.alias("start"), (start + m["n"]).alias("end"), *keep(m))
            return F.struct((start + m["n"]).alias("at"), F.array_append(held["out"], one).alias("out"))

        none = F.array().cast(kind)
        return F.aggregate(block, F.struct(begin.alias("at"), none.alias("out")), step, lambda held: held["out"])

    def over(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, m: s + m["gap"] + m["n"]))
        begins = let(sizes, lambda s: F.transform(
            F.sequence(F.lit(1), F.size(s)), lambda k: F.aggregate(F.slice(s, F.lit(1), k - 1), F.lit(0), lambda a, b: a + b)
        ))
        return F.flatten(F.zip_with(blocks, begins, in_block))

    def cut(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(all_) > 0, let(blocks, over)).otherwise(F.array().cast(kind))

    return let(matches, cut)


def _digits(value: Column) -> Column:
    return F.translate(value, " ().+-", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum over digits from the right, every second doubled, ends in 0."""

    def total(rev: Column) -> Column:
        def add(s: Column, i: Column) -> Column:
            d = F.substr(rev, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return s + d - F.when(d > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), add)

    return let(F.reverse(digits), total) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is one of the kind."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(MIN_CARD, MAX_CARD), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(MIN_PHONE, MAX_PHONE)
    return F.lit(True)


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap test that every text with a span of the kind passes."""
    if kind == "email":
        return text.contains("@")
    if kind == "phone":
        return text.contains("+")
    return text.rlike(r"[0-9]\.[0-9]+\.[0-9]" if kind == "ip" else r"[0-9](?:[\x20-]?[0-9]){15}")


def _entity(kind: str, value: Column) -> Column:
    """The protected entity that a value names: however it is written."""
    plain = F.lower(value) if kind == "email" else _digits(value) if kind in ("card", "phone") else value
    return F.concat(F.lit(f"{kind}:"), plain)


def without_emails(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)


def masked(text: Column) -> Column:
    """The text with every code point of an e-mail address replaced by a full stop: places stay."""

    def parts(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0))
        return F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(g, F.repeat(F.lit("."), F.coalesce(F.length(m), F.lit(0))))), "")

    return F.when(text.contains("@"), let(F.split(text, PATTERNS["email"], -1), parts)).otherwise(text)


def _context(m: Column) -> Column:
    """Terms next to a match; words cut by the limit of code points do not count."""
    before, after = F.right(m["before"], F.lit(CONTEXT_CHARS)), F.left(m["after"], F.lit(CONTEXT_CHARS))
    before = F.when(F.length(m["before"]) > CONTEXT_CHARS, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
    after = F.when(F.length(m["after"]) > CONTEXT_CHARS, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
    words = [F.regexp_extract_all(F.lower(without_emails(x)), F.lit(WORD), F.lit(0)) for x in (before, after)]
    near = let(words[0], lambda w: F.slice(w, F.greatest(F.size(w) - CONTEXT_WORDS, F.lit(0)) + 1, F.lit(CONTEXT_WORDS)))
    return F.array_distinct(F.concat(near, F.slice(words[1], 1, CONTEXT_WORDS)))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, digest, email, ip, card, phone, mentions).

    The kinds are arrays of (start, end); ``mentions`` has (entity, terms) of each
    span; ``digest`` is that of the text, null where nothing was found.
    """
    text = F.col("text")
    found = id_and_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    element = "array<struct<start:int,end:int,value:string,entity:string,terms:array<string>>>"
    for kind in KINDS:

        def keep(m, kind=kind):
            ok = valid(kind, m["value"])
            return m["value"].alias("value"), F.when(ok, _entity(kind, m["value"])).alias("entity"), F.when(ok, _context(m)).alias("terms")

        spans = F.filter(_placed(_matches(text, PATTERNS[kind]), keep, element), lambda s: s["entity"].isNotNull())
        found = found.withColumn(kind, F.when(_may_hold(kind, text), spans).otherwise(F.array().cast(element)))
    every = F.concat(*KINDS)
    return found.select(
        "doc_id", F.when(F.size(every) > 0, F.md5("text")).alias("digest"),
        *[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS],
        F.transform(every, lambda s: F.struct(s["entity"].alias("entity"), s["terms"].alias("terms"))).alias("mentions"),
    )


def _two_texts(grouped: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Documents per key, of the keys that occur in two different texts: map-side sums and extremes only."""
    agg = grouped.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.min("digest").alias("least"), F.max("digest").alias("most"))
    return agg.where("least < most").drop("least", "most")


def _pairs_of(row_mentions: Column) -> Column:
    """Distinct (entity, term) of one document."""
    each = F.transform(row_mentions, lambda m: F.transform(m["terms"], lambda t: F.struct(m["entity"].alias("entity"), t.alias("term"))))
    return F.array_distinct(F.flatten(each))


def disclosures(found: DataFrame, docs: DataFrame, threshold: float = GENERALISE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(entity, term, disclosure) of ``threshold`` at least; ``found`` is the stored result of ``find`` on ``docs``."""
    mentions = found.where(F.size("mentions") > 0)
    entities = _two_texts(mentions.select("digest", F.explode(F.array_distinct(F.col("mentions.entity"))).alias("entity")), ["entity"], "n_c")
    pairs = _two_texts(
        mentions.select("digest", F.explode(_pairs_of(F.col("mentions"))).alias("pair")).select("digest", "pair.entity", "pair.term"), ["entity", "term"], "n_ct"
    )
    words = F.regexp_extract_all(F.lower(without_emails(F.col("text"))), F.lit(WORD), F.lit(0))
    terms = id_and_text(docs, id_col, text_col).select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = F.lit(float(found.count()))
    pmi = F.log(total * F.col("n_ct") / (F.col("n_c") * F.col("n_t")))
    known = pairs.join(entities, "entity").join(terms, "term").where(F.col("n_c") < total)
    return known.select("entity", "term", (pmi / F.log(total / F.col("n_c"))).alias("disclosure")).where(F.col("disclosure") >= threshold)


def risky_terms(found: DataFrame, risks: DataFrame) -> DataFrame:
    """(doc_id, digest, term, disclosure): the terms to sanitise in each document, at their highest disclosure."""
    pairs = found.where(F.size("mentions") > 0).select("doc_id", "digest", F.explode(_pairs_of(F.col("mentions"))).alias("pair"))
    hits = pairs.select("doc_id", "digest", "pair.entity", "pair.term").join(risks, ["entity", "term"])
    return hits.groupBy("doc_id", "digest", "term").agg(F.max("disclosure").alias("disclosure"))


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["digest"] == b["digest"])


def term_spans(docs: DataFrame, risky: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, terms array of (start, end, word, disclosure)): every occurrence of its risky terms in a document."""
    text = F.col("text")
    gate = F.lit(False)
    for kind in KINDS:
        gate = gate | _may_hold(kind, text)
    texts = id_and_text(docs, id_col, text_col).where(gate).select("doc_id", F.md5("text").alias("digest"), "text")
    wanted = risky.select("doc_id", "digest").distinct()
    held = texts.join(wanted, _same_document(texts, wanted), "left_semi").dropDuplicates(["doc_id", "digest"])
    words = _placed(_matches(masked(text), WORD), lambda m: (m["value"].alias("value"),), _SPANS)
    each = held.select("doc_id", "digest", F.explode(words).alias("w")).select(
        "doc_id", "digest", "w.start", "w.end", F.col("w.value").alias("word"), F.lower("w.value").alias("term")
    )
    hits = each.join(risky, _same_document(each, risky) & (each["term"] == risky["term"])).select(
        each["doc_id"], each["digest"], "start", "end", "word", "disclosure"
    )
    return hits.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("start", "end", "word", "disclosure"))).alias("terms"))


def _as_text(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def scan(docs: DataFrame, threshold: float = GENERALISE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, digest of the base spans, all spans, and the number of terms."""
    folder = new_run_folder(docs)
    found = materialize(find(docs, id_col, text_col), folder, "found")
    risks = materialize(disclosures(found, docs, threshold, id_col, text_col), folder, "risks")
    risky = materialize(risky_terms(found, risks), folder, "risky")
    added = term_spans(docs, risky, id_col, text_col)
    # Documents without a mention take no part in the join.
    some, none = found.where("digest IS NOT NULL"), found.where("digest IS NULL")
    joined = some.join(added, _same_document(some, added), "left").select(some["doc_id"], *KINDS, "terms")
    rows = joined.unionByName(none.select("doc_id", *KINDS, F.lit(None).cast("array<struct<start:int,end:int,word:string,disclosure:double>>").alias("terms")))
    terms = F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,word:string,disclosure:double>>"))
    base = F.concat_ws(",", *[_as_text(k, F.col(k)) for k in KINDS])
    return rows.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", *[_as_text(k, F.col(k)) for k in KINDS], _as_text(TERM, terms)).alias("spans"),
        F.size(terms).cast("bigint").alias("n_term"),
    )


def _rewritten(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with each match replaced by ``change`` of it."""

    def parts(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(g, F.when(m.isNull(), "").otherwise(change(m)))), "")

    return let(F.split(text, pattern, -1), parts)


def shape(word: Column) -> Column:
    """What a term is generalised to."""
    return F.when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")


def sanitise(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): personal data replaced by its kind, terms generalised to their shape or removed.

    Terms go first, then the kinds in their order; a kind is looked for in what the earlier ones left. A null text stays null.
    """
    folder = new_run_folder(docs)
    found = materialize(find(docs, id_col, text_col), folder, "found")
    risks = materialize(disclosures(found, docs, generalise, id_col, text_col), folder, "risks")
    risky = risky_terms(found, risks).groupBy("doc_id", "digest").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("risky")
    )
    risky = materialize(risky, folder, "risky")
    texts = id_and_text(docs, id_col, text_col).withColumn("digest", F.md5("text"))
    joined = texts.join(risky, _same_document(texts, risky), "left").select(texts["doc_id"], "text", "risky")

    def term(m: Column) -> Column:
        level = F.try_element_at(F.col("risky"), F.lower(m))
        return F.when(level >= remove, "").when(level >= generalise, shape(m)).otherwise(m)

    # Words inside e-mail addresses are no terms, so only the texts between addresses are rewritten.
    gaps = F.transform(F.split(F.col("text"), PATTERNS["email"], -1), lambda g: _rewritten(g, WORD, term))
    mails = F.regexp_extract_all(F.col("text"), F.lit(PATTERNS["email"]), F.lit(0))
    replaced = F.array_join(F.zip_with(gaps, mails, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    out = joined.select("doc_id", F.when(F.col("risky").isNull(), F.col("text")).otherwise(replaced).alias("text"))
    for kind in KINDS:
        mark = F.lit(f"[{kind.upper()}]")
        new = _rewritten(F.col("text"), PATTERNS[kind], lambda m, kind=kind, mark=mark: F.when(valid(kind, m), mark).otherwise(m))
        out = out.select("doc_id", F.when(_may_hold(kind, F.col("text")), new).otherwise(F.col("text")).alias("text"))
    return out


def op13_pii_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms of every whole text of ``documents``."""
    return scan(read(spark, sf_dir, "documents"))
