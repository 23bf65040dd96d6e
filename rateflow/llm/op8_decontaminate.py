"""Benchmark decontamination by canonical templates.

Words (white space apart, signs at their ends dropped, ASCII and Latin-1
letters in lower case) become template tokens: numbers, names (capitalised
inside a sentence; neighbouring ones are one name) and units are replaced by
typed placeholders, whose texts are kept as slots. Windows of ``WINDOW``
template tokens are hash-joined between documents and benchmark items; a window
of fewer than ``MIN_LITERALS`` literal tokens is joined with its slot texts, so
only verbatim. Matches on one diagonal (document place minus item place)
are one passage. A slot agrees if its text is the item's or the one document
value that replaces the item value most often; two item values may meet in one
document value. If ``MIN_AGREE`` of a passage's slots agree, which a
re-parameterised question keeps and unrelated text with the same wording does
not, every window whose slots agree counts. Otherwise its verbatim windows
count: those that hold a slot, and those in ``MIN_RUN`` consecutive verbatim
windows. A document is contaminated by an item if the windows that count are
``MIN_COVERAGE`` or more of the item's windows, or of its windows of enough
literals, or if a passage holds ``MIN_RUN`` consecutive verbatim windows,
whatever their share. The greater share is the coverage reported.

Items of fewer than ``WINDOW`` tokens are matched by one window of their own
length; items of fewer than ``MIN_LITERALS`` literal tokens are never
matched. Null and empty texts match nothing. Rows are judged by id and text: rows
that share an id (null too) with different texts are different documents, and
only the query's output names a document by its id alone. Items are told apart
by their texts; each id that has the text is reported.

The benchmark's windows are looked up in each task. That table is broadcast in
slices of ``SLICE_WINDOWS`` windows at most (whole items); a larger benchmark
takes one pass over the documents for each slice.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm import vec
from rateflow.llm.common import id_and_text, materialize, new_run_folder, null_ids_back, read, ship, text_chunks

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERAGE = 0.25
MIN_AGREE = 0.75
MIN_RUN = 6  # 13 consecutive tokens
SLICE_WINDOWS = 1 << 20
CHUNK = 1 << 20
JUDGED_AT_ONCE = 64

# Words that count as numbers and as units.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
UNIT_WORDS = "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees celsius fahrenheit mph kph watt watts volt volts meter meters metre metres kilometer kilometers kilometre kilometres"


def _hash_words(words: str) -> np.ndarray:
    raw = np.frombuffer(words.encode() + bytes(64), np.uint8)
    starts, ends, _ = vec.word_bounds(raw, np.array([0, len(words)]))
    return np.sort(vec.word_hashes(raw, starts, ends))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table; a table of bits by the low bits of the value answers most of the time."""
    bits = np.zeros(1 << max(16, min(23, int(len(table) * 16).bit_length())), bool)
    low = np.uint64(len(bits) - 1)
    bits[table & low] = True
    out = bits[values & low]
    maybe = np.flatnonzero(out)
    if len(maybe):
        at = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
        out[maybe] = table[at] == values[maybe]
    return out


_NUMBERS, _UNITS = _hash_words(NUMBER_WORDS), _hash_words(UNIT_WORDS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_DIGIT, _LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_STOP[list(b".!?:;|")] = True
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
_TOLD = np.uint64(0xD6E8FEB86659FD93)
_PLACEHOLDER = vec.mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def template(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, kinds, slot hashes, tokens before each document) of documents laid end to end."""
    n = int(offsets[-1])
    raw = buf[:n]
    starts, ends, _ = vec.word_bounds(buf, offsets)
    body = np.flatnonzero(~(_SIGN[raw] | (raw <= 32)))
    first, last = np.searchsorted(body, starts), np.searchsorted(body, ends)
    some = last > first
    raw_starts, raw_ends = starts[some], ends[some]
    starts, ends = body[first[some]], body[last[some] - 1] + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lower = _LOWER[buf]
    accent = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
    lower[accent] += 32
    word = vec.word_hashes(lower, starts, ends)
    kind = np.zeros(len(starts), np.int8)
    digits = np.flatnonzero(_DIGIT[raw])
    if len(digits):
        n_digits = np.searchsorted(digits, ends) - np.searchsorted(digits, starts)
        cand = np.flatnonzero(n_digits > 0)
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw], dtype=np.int32)])
        n_letters = letters[ends[cand]] - letters[starts[cand]]
        kind[cand[(n_letters == 0) | (_DIGIT[raw[starts[cand]]] & (n_letters <= 3))]] = NUMBER
    kind[_is_in(word, _NUMBERS)] = NUMBER
    kind[_is_in(word, _UNITS) & (kind == LITERAL)] = UNIT
    opening = raw[starts]
    after = buf[starts + 1]
    upper = ((opening >= 65) & (opening <= 90) & ~((after >= 65) & (after <= 90))) | ((opening == 0xC3) & (after >= 0x80) & (after <= 0x9E))
    upper &= ends - starts > 1
    cand = np.flatnonzero(upper & (kind == LITERAL))
    cand = cand[(cand > 0) & (np.searchsorted(offsets, starts[cand], "right") == np.searchsorted(offsets, starts[cand - 1], "right"))] if len(cand) else cand
    breaks = np.flatnonzero((raw == 10) | (raw == 13))
    inside = ~_STOP[raw[raw_ends[cand - 1] - 1]] & (np.searchsorted(breaks, raw_starts[cand]) == np.searchsorted(breaks, raw_ends[cand - 1]))
    kind[cand[inside]] = NAME
    # A name right after a name belongs to it.
    joined = np.zeros(len(kind), bool)
    joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME)
    head = np.flatnonzero(~joined)
    slot = np.add.reduceat(word, head)
    kind, starts, word = kind[head], starts[head], word[head]
    token = np.where(kind == LITERAL, word, _PLACEHOLDER[kind])
    return token, kind, slot, np.searchsorted(starts, offsets)


def windows(token: np.ndarray, kind: np.ndarray, slot: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``size`` tokens inside one document, and whether they hold enough literals.

    Windows of too few literals are hashed by the texts of their tokens; those shorter than WINDOW are left out.
    """
    if len(token) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    hashes = vec.join_hashes(token, size)
    literals = np.concatenate([[0], np.cumsum(kind == LITERAL, dtype=np.int32)])
    literal = literals[size:] - literals[:-size] >= MIN_LITERALS
    inside = np.ones(len(hashes), bool)
    for e in bounds[1:-1]:
        inside[max(0, e - size + 1) : e] = False
    if size == WINDOW:
        few = np.flatnonzero(inside & ~literal)
        exact = np.full(len(few), _TOLD)
        for k in range(size):
            exact = vec.mix(exact + slot[few + k])
        hashes[few] = exact
    else:
        inside &= literal
    at = np.flatnonzero(inside)
    return at, hashes[at], literal[at]


WINDOW_SCHEMA = "{id} bigint, {node} binary, size int, hash bigint, place int, slots array<bigint>, slot_at array<int>, literal boolean"


def text_digest(text: Column) -> Column:
    """The digest of a text's UTF-8 bytes; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _window_rows(
    id_name: str, node_name: str, ids: np.ndarray, buf: np.ndarray, offsets: np.ndarray, at: np.ndarray, hashes: np.ndarray, literal: np.ndarray, size: int,
    kind: np.ndarray, slot: np.ndarray, bounds: np.ndarray,
) -> pa.RecordBatch:
    doc = np.searchsorted(bounds, at, "right") - 1
    nodes = {d: hashlib.md5(buf[offsets[d] : offsets[d + 1]]).digest() for d in np.unique(doc).tolist()}
    flat = vec.spans_to_flat(at, np.full(len(at), size))
    is_slot = kind[flat] != LITERAL
    ends = np.concatenate([[0], np.cumsum(is_slot.reshape(len(at), size).sum(1))]) if len(at) else np.zeros(1, np.int64)
    ends = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_pydict({
        id_name: null_ids_back(ids[doc]), node_name: pa.array([nodes[d] for d in doc.tolist()], pa.binary()), "size": pa.array(np.full(len(at), size, np.int32)), "hash": hashes.view(np.int64),
        "place": (at - bounds[doc]).astype(np.int32),
        "slots": pa.ListArray.from_arrays(ends, pa.array(slot[flat][is_slot].view(np.int64))),
        "slot_at": pa.ListArray.from_arrays(ends, pa.array((flat - np.repeat(bounds[doc], size))[is_slot].astype(np.int32))), "literal": literal,
    })


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Every window of every item; an item of fewer than WINDOW tokens has one of its own length."""
    ship(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, buf, offsets in text_chunks(batch, CHUNK):
                token, kind, slot, bounds = template(buf, offsets)
                length = np.diff(bounds)
                for size in np.unique(np.minimum(length, WINDOW)).tolist():
                    if size < MIN_LITERALS:
                        continue
                    at, hashes, literal = windows(token, kind, slot, bounds, size)
                    own = length[np.searchsorted(bounds, at, "right") - 1]
                    mine = own == size if size < WINDOW else own >= WINDOW
                    yield _window_rows("item_id", "item", ids, buf, offsets, at[mine], hashes[mine], literal[mine], size, kind, slot, bounds)

    return id_and_text(benchmark, id_col, text_col).mapInArrow(run, WINDOW_SCHEMA.format(id="item_id", node="item"))


def document_windows(docs: DataFrame, tables: dict[int, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The windows of every document whose hash is in the table of its size."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]):
        known = {size: np.frombuffer(data, np.uint64) for size, data in sent.value.items()}
        for batch in batches:
            for ids, buf, offsets in text_chunks(batch, CHUNK):
                token, kind, slot, bounds = template(buf, offsets)
                for size, table in known.items():
                    at, hashes, literal = windows(token, kind, slot, bounds, size)
                    hit = _is_in(hashes, table)
                    if hit.any():
                        yield _window_rows("doc_id", "node", ids, buf, offsets, at[hit], hashes[hit], literal[hit], size, kind, slot, bounds)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, WINDOW_SCHEMA.format(id="doc_id", node="node"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per contaminated document id and item id: windows matched, coverage, whether slots were exchanged."""
    found = contaminated_rows(docs, benchmark, min_coverage, id_col, text_col, item_id_col, item_text_col)
    told = ["coverage", "n_matched", "n_windows", "slots_exchanged"]
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(*told)).alias("best"))
    return best.select("doc_id", "item_id", *[f"best.{c}" for c in ("n_matched", "n_windows", "coverage", "slots_exchanged")])


def contaminated_rows(
    docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """As ``contaminated``, with one row per (doc_id, node) and (item_id, item): the ids and the texts' digests."""
    spark = docs.sparkSession
    folder = new_run_folder(spark)
    bench = id_and_text(benchmark, item_id_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    named = bench.select("item_id", text_digest(F.col("text")).alias("item")).distinct()
    items = materialize(item_windows(bench.dropDuplicates(["text"])).drop("item_id"), folder, "items")
    n = items.count()
    slices = max(1, -(-n // SLICE_WINDOWS))
    # Items are dealt by text; one item's windows stay in one slice, so a slice is bounded up to the longest item.
    dealt = items.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(slices)))
    found = None
    for k in range(slices):
        part = dealt.where(F.col("slice") == k).drop("slice")
        rows = part.select("size", "hash").distinct().toPandas()
        tables = {int(s): np.sort(g["hash"].to_numpy(np.int64).view(np.uint64)).tobytes() for s, g in rows.groupby("size")}
        one = _judged(document_windows(docs, tables, id_col, text_col), part, min_coverage)
        found = one if found is None else found.unionByName(one)
    return found.join(F.broadcast(named), "item")


Window = tuple[int, list[tuple[int, int, int]]]  # the window's place in the item and its slots: (place, item text, document text)


def runs(places: list[int]) -> Iterator[list[int]]:
    """The maximal stretches of consecutive places."""
    part: list[int] = []
    for p in sorted(places):
        if part and p != part[-1] + 1:
            yield part
            part = []
        part.append(p)
    if part:
        yield part


def counting(passage: list[Window]) -> tuple[set[int], bool]:
    """The windows of one passage that count, and whether slots of them were exchanged."""
    spots = {at: (i, d) for _, slots in passage for at, i, d in slots}
    most: dict[int, tuple[int, int]] = {}
    for (i, d), n in Counter(p for p in spots.values() if p[0] != p[1]).items():
        most[i] = max(most.get(i, (0, 0)), (n, d))
    agrees = {at for at, (i, d) in spots.items() if i == d or most[i][1] == d}
    if len(agrees) >= MIN_AGREE * len(spots):
        good = [(place, slots) for place, slots in passage if all(at in agrees for at, _, _ in slots)]
        return {place for place, _ in good}, any(i != d for _, slots in good for _, i, d in slots)
    verbatim = {place: bool(slots) for place, slots in passage if all(i == d for _, i, d in slots)}
    long = {p for run in runs(list(verbatim)) if len(run) >= MIN_RUN for p in run}
    return {p for p, holds in verbatim.items() if holds or p in long}, False


def judge(found: list[tuple[int, Window]]) -> tuple[set[int], bool, int]:
    """Of the windows (diagonal, window) that one document shares with one item: those that count, whether slots were exchanged, the longest verbatim run."""
    passages: dict[int, list[Window]] = defaultdict(list)
    for diagonal, window in found:
        passages[diagonal].append(window)
    covered: dict[int, bool] = {}
    longest = 0
    for passage in passages.values():
        places, exchanged = counting(passage)
        for p in places:
            covered[p] = covered.get(p, True) and exchanged
        verbatim = {place for place, slots in passage if all(i == d for _, i, d in slots)}
        longest = max(longest, *(len(r) for r in runs(list(verbatim)))) if verbatim else longest
    return set(covered), any(covered.values()), longest


def _judged(matches: DataFrame, items: DataFrame, min_coverage: float) -> DataFrame:
    item = F.broadcast(items.select("item", "size", "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "slot_at", "literal"))
    of = items.groupBy("item").agg(F.count("*").alias("n_all"), F.count_if("literal").alias("n_literal"))
    key = ["doc_id", "node", "item"]
    slots = F.arrays_zip(F.col("slot_at").alias("at"), F.col("item_slots").alias("i"), F.col("slots").alias("d"))
    pairs = matches.drop("slot_at", "literal").join(item, ["size", "hash"]).select(*key, F.struct((F.col("place") - F.col("item_place")).alias("diagonal"), "item_place", "literal", slots.alias("slots")).alias("window"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in range(0, batch.num_rows, JUDGED_AT_ONCE):
                part = batch.slice(k, JUDGED_AT_ONCE)
                got, of_literals = [], []
                for windows in part.column("windows").to_pylist():
                    got.append(judge([(w["diagonal"], (w["item_place"], [(s["at"], s["i"], s["d"]) for s in w["slots"]])) for w in windows]))
                    of_literals.append(len(got[-1][0] & {w["item_place"] for w in windows if w["literal"]}))
                told = {
                    "all_matched": pa.array([len(g[0]) for g in got], pa.int64()), "literal_matched": pa.array(of_literals, pa.int64()),
                    "slots_exchanged": pa.array([g[1] for g in got], pa.bool_()), "run": pa.array([g[2] for g in got], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict({**{c: part.column(c) for c in key}, **told})

    passages = pairs.groupBy(*key).agg(F.collect_set("window").alias("windows"))
    total = passages.mapInArrow(run, "doc_id bigint, node binary, item binary, all_matched bigint, literal_matched bigint, slots_exchanged boolean, run bigint")
    both = [F.struct((F.col(n) / F.nullif(of_n, F.lit(0))).alias("coverage"), F.col(n).alias("n_matched"), of_n.alias("n_windows")) for n, of_n in (("all_matched", F.col("n_all")), ("literal_matched", F.col("n_literal")))]
    return (
        total.join(F.broadcast(of), "item")
        .withColumn("best", F.greatest(*both))
        .select(*key, "best.n_matched", "best.n_windows", "best.coverage", "slots_exchanged", "run")
        .where((F.col("n_matched") > 0) & ((F.col("coverage") >= min_coverage) | (F.col("run") >= MIN_RUN)))
        .drop("run")
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents of ``documents``, with the items found in them."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
