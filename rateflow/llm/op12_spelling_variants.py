"""Spelling variants: words that differ by one edit, grouped under their commonest form.

Two words are near if exactly one inserted, deleted or replaced code point
turns one into the other. Near words are found with pivotal grams. The bigrams
of a word are ordered by how rare they are among all words (ties: by place);
the first three are its prefix. One edit spoils at most one of two disjoint
bigrams, and three bigrams always hold two disjoint ones: dynamic programming
picks the two whose index lists are shortest together, the pivots. Of two near
words let r be the one whose prefix ends first in that order; then a pivot of r that
the edit spares stands in the other word's prefix, its place shifted by one at most.
So every word is indexed by its prefix bigrams and looked up by its pivots.

Position limits make the lookup narrow. Let the pivots be p before q. If the
edit lies before q, then q is spared and all from q to the word's end
is equal; else p is spared and all up to and with p is equal. On the other side of
the spared pivot one half, as the indexed word cuts it, is free of the edit
too. So the key of a lookup is the word's length, the pivot's place counted from
the equal end, the equal text and the equal half. Keys are 64-bit hashes; every
hit is verified, so a collision costs a comparison and no wrong or lost pair.
Each word sends at most 12 lookups and 16 index entries, whatever its length.

The index is a Spark join on those keys. It and every other join on words is hinted to
sort and merge: a table of words may be small in its file, and the planner would
broadcast it, through the driver. The order of bigrams is a table of at
most 90 x 90 rows, since words are made of the letters a-z and U+00C0 to U+00FF only.

A word's form is its near word of largest count (ties: smallest in code-point
order), if that is at least twice the word's own; counts double along
forms, so chains are short and their ends, the roots, follow by pointer doubling.

Null and empty texts have no words; a null id counts as empty in the noise
draw. Rows that repeat count each. A text is read in pieces cut
between words, so a very long one costs time but no more memory; a very
long word is kept whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import id_and_text, materialize, new_run_folder, read, row_groups, ship, text_buffer

MIN_LENGTH, MIN_COUNT = 5, 3
#: A form must occur this many times as often as its variant.
FORM_RATIO = 2
#: Of so many hash values one drops a letter of a run (the query's spelling noise).
NOISE_MODULUS = 97
GRAM, PREFIX = 2, 3
#: Letters of words: a-z, then U+00C0 to U+00FF.
LATIN = 26
LETTERS = LATIN + 0x100 - 0xC0

#: Code points beyond which two words are not compared by the built-in distance.
LONG_WORD = 128
CHUNK = 4 << 20
PIECE = 1 << 20
#: Distinct words, and their characters, that a task holds before it passes their counts on.
HELD_WORDS, HELD_CHARS = 200_000, 16 << 20
ROWS = 20_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BREAK = re.compile("[^a-zÀ-ÿ]")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut outside words only."""
    at = 0
    while len(text) - at > size:
        cut = _BREAK.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def with_noise(word: str, id_crc: int, modulus: int) -> str:
    """The word, one letter less if the hash of id and word is a multiple of ``modulus``."""
    h = zlib.crc32(word.encode(), id_crc)
    if h % modulus:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, noise: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) over all texts: maximal runs of letters, A-Z lower-cased, of ``min_length`` code points at least."""
    ship(docs.sparkSession)
    # A run that is shorter can only become shorter, so it is not even looked at.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def flush(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    def run(batches):
        held, size = Counter(), 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            raw, at = text_buffer(batch.column("text"))
            for lo, hi in row_groups(np.diff(at), CHUNK):
                data = raw[at[lo] : at[hi]].tobytes().translate(_LOWER)
                for k in range(lo, hi):
                    text = data[at[k] - at[lo] : at[k + 1] - at[lo]].decode("utf-8")
                    found = Counter()
                    for piece in pieces(text):
                        found.update(runs.findall(piece))
                    id_crc = zlib.crc32(f"{'' if ids[k] is None else ids[k]}:".encode())
                    for word, n in found.items():
                        if noise:
                            word = with_noise(word, id_crc, noise)
                            if len(word) < min_length:
                                continue
                        if word not in held:
                            size += len(word)
                        held[word] += n
                    if len(held) > HELD_WORDS or size > HELD_CHARS:
                        yield flush(held)
                        held, size = Counter(), 0
        yield flush(held)

    counted = id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def gram_ids(word: str) -> np.ndarray:
    codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    codes = np.where(codes < 0xC0, codes - 97, codes - 0xC0 + LATIN)
    return codes[:-1] * LETTERS + codes[1:]


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each possible bigram stands in the words: one number per pair of letters."""
    ship(words.sparkSession)

    def run(batches):
        total = np.zeros(LETTERS * LETTERS, np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                np.add.at(total, gram_ids(word), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    out = np.zeros(LETTERS * LETTERS, np.int64)
    rows = words.select("word").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most LETTERS * LETTERS rows, whatever the corpus
        out[row["gram"]] = row["n"]
    return out


def cheapest_disjoint(places: list[int], costs: list[int], k: int = 2) -> list[int]:
    """Of bigrams at ascending ``places`` the k pairwise disjoint ones of least total cost.

    ``best[i][j]`` is the least cost of j disjoint ones among the first i.
    """
    n = len(places)
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * k]
    for i in range(1, n + 1):
        before = i - 1
        while before and places[before - 1] > places[i - 1] - GRAM:
            before -= 1
        row: list[tuple[int, list[int]] | None] = [(0, [])]
        for j in range(1, k + 1):
            without, rest = best[i - 1][j], best[before][j - 1]
            taken = None if rest is None else (rest[0] + costs[i - 1], rest[1] + [places[i - 1]])
            row.append(min((x for x in (without, taken) if x is not None), key=lambda x: x[0], default=None))
        best.append(row)
    return best[n][k][1]


def prefix_of(word: str, ranks: np.ndarray) -> list[tuple[int, int]]:
    """(rank, place) of the first bigrams in the global order, one more than ``PREFIX``."""
    order = (ranks[gram_ids(word)] << 32) | np.arange(len(word) - 1)
    if len(order) > PREFIX + 1:
        order = np.partition(order, PREFIX)[: PREFIX + 1]
    return [(x >> 32, x & 0xFFFFFFFF) for x in sorted(order.tolist())]


def index_keys(word: str, place: int) -> list[str]:
    """The keys under which a prefix bigram is found: equal text to its left or right, and one half of the rest."""
    n = len(word)
    left, right = place, n - place - GRAM
    cut, back = place + GRAM + right // 2, place - left // 2
    return [
        f"A{place}:{n}:{word[:cut]}",
        f"B{place}:{n}:{word[: place + GRAM]}|{word[cut:]}",
        f"C{right}:{n}:{word[back:]}",
        f"D{right}:{n}:{word[:back]}|{word[place:]}",
    ]


def lookup_keys(word: str, p: int, q: int) -> list[str]:
    """The index keys of any near word that holds the pivot p (edit at or after q) or q (edit before q)."""
    n = len(word)
    keys = []
    for other in (n - 1, n, n + 1):
        rest = other - p - GRAM  # length of what follows p in the near word
        if rest >= 0:
            half = rest // 2
            keys.append(f"A{p}:{other}:{word[: p + GRAM + half]}")
            keys.append(f"B{p}:{other}:{word[: p + GRAM]}|{word[n - (rest - half) :]}")
        right = n - q - GRAM
        rest = other - right - GRAM  # length of what stands before q in the near word
        if rest >= 0:
            half = rest // 2
            keys.append(f"C{right}:{other}:{word[max(q - half, 0) :]}")
            keys.append(f"D{right}:{other}:{word[: rest - half]}|{word[q:]}")
    return keys


def _signed(key: str) -> int:
    h = xxhash.xxh64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def _keyed(words: DataFrame, ranks: np.ndarray, costs: np.ndarray, lookups: bool) -> DataFrame:
    """(key, word, last) of the index entries, or of the lookups; ``last`` is where the prefix ends in the global order."""

    def keys_of(word: str) -> tuple[set[int], int]:
        prefix = prefix_of(word, ranks)
        rank, place = prefix[PREFIX - 1]
        if lookups:
            first = sorted((at, r) for r, at in prefix[:PREFIX])
            p, q = cheapest_disjoint([at for at, _ in first], [int(costs[r]) for _, r in first])
            texts = lookup_keys(word, p, q)
        else:
            # A spared pivot may stand one place further than the prefix of the other word reaches (as in "aaaa").
            texts = [k for x in prefix if x <= (rank, place + 1) for k in index_keys(word, x[1])]
        return {_signed(k) for k in texts}, (rank << 32) | place

    def run(batches):
        for batch in batches:
            keys, texts, lasts = [], [], []
            for word in batch.column("word").to_pylist():
                found, last = keys_of(word)
                keys += found
                texts += [word] * len(found)
                lasts += [last] * len(found)
                if len(keys) >= ROWS or len(word) > ROWS:
                    yield pa.RecordBatch.from_pydict({"key": keys, "word": texts, "last": lasts}, schema)
                    keys, texts, lasts = [], [], []
            yield pa.RecordBatch.from_pydict({"key": keys, "word": texts, "last": lasts}, schema)

    schema = pa.schema([("key", pa.int64()), ("word", pa.string()), ("last", pa.int64())])
    return words.select("word").mapInArrow(run, "key bigint, word string, last bigint")


def one_edit(a: Column, b: Column) -> Column:
    """Whether two different words are one edit apart.

    The built-in distance takes time square in the length, so words over
    ``LONG_WORD`` are compared around their common prefix, found by doubling.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    one = F.lit(1)
    shared = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.substr(a, one, at + step) == F.substr(b, one, at + step), at + step).otherwise(at))
    longer, shorter = F.length(a) - F.length(b), F.length(b) - F.length(a)
    rest = F.when(longer == 0, F.substr(a, shared + 2) == F.substr(b, shared + 2))
    rest = rest.when(longer == 1, F.substr(a, shared + 2) == F.substr(b, shared + 1))
    rest = rest.when(shorter == 1, F.substr(a, shared + 1) == F.substr(b, shared + 2)).otherwise(False)
    short = F.greatest(F.length(a), F.length(b)) <= LONG_WORD
    return F.when(short, F.levenshtein(a, b, 1) == 1).otherwise(rest)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every pair of near words once, in either order.

    ``words`` should be a stored table (it is read three times) of distinct
    words of five letters at least, made of the letters a-z and U+00C0 to U+00FF.
    """
    ship(words.sparkSession)
    counts = gram_counts(words)
    order = np.argsort(counts, kind="stable")  # rare first; ties by gram
    ranks = np.empty_like(order)
    ranks[order] = np.arange(len(order))
    by_rank = counts[order]
    look = _keyed(words, ranks, by_rank, lookups=True).alias("look")
    index = _keyed(words, ranks, by_rank, lookups=False).alias("index")
    same = F.col("look.key") == F.col("index.key")
    first = (F.col("look.last") < F.col("index.last")) | (
        (F.col("look.last") == F.col("index.last")) & (F.col("look.word") < F.col("index.word"))
    )
    pairs = look.join(index.hint("merge"), same & first & one_edit(F.col("look.word"), F.col("index.word"))).select(F.col("look.word").alias("a"), F.col("index.word").alias("b"))
    return pairs.distinct()


def with_forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): near words counted, and the commonest if it is common enough.

    A word has no more near words than there are single edits of it, so no group grows with the corpus.
    """
    sides = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"))))
    both = pairs.select(sides.alias("side")).select("side.word", "side.near")
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near"))).alias("best")
    )
    common = -F.col("best.minus_n") >= ratio * F.col("n")
    return words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.minus_n")).alias("form_n"),
    )


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of the words that have a form: the last of the chain, by pointer doubling.

    Counts at least double along a chain, so it has under 64 steps and the loop at most seven turns.
    """
    known = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), folder, "roots0")
    turn = 0
    while True:
        turn += 1
        next_ = known.select(F.col("word").alias("via"), F.col("root").alias("further"))
        moved = known.join(next_.hint("merge"), F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = materialize(moved, folder, f"roots{turn}")
        known = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return known


def variant_groups(counts: DataFrame, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words that occur ``min_count`` times at least."""
    folder = new_run_folder(counts.sparkSession)
    words = materialize(counts.where(F.col("n") >= min_count), folder, "words")
    pairs = materialize(near_pairs(words), folder, "pairs")
    forms = materialize(with_forms(words, pairs, ratio), folder, "forms")
    return forms.join(roots(forms, folder).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of every whole text of ``documents``, with the query's noise."""
    return variant_groups(word_counts(read(spark, sf_dir, "documents"), noise=NOISE_MODULUS))
