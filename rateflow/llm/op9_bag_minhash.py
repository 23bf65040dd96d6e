"""Near-duplicate documents by BagMinHash signatures of word shingles.

A document is the multiset of its shingles of five words (a shorter document
is one shingle). Each shingle has a Poisson process over time and weight:
its weight axis is cut into the dyadic intervals (0,1], (1,2], (2,4], ... and
the process of an interval is drawn only if the shingle's weight reaches into it. A point that
falls into an interval the weight covers in part is placed by halving the
interval, and counts if its cell lies below the weight. Each point hits one of the
signature's slots, and a slot keeps its earliest point. Two signatures then
agree in a slot with probability sum(min) / sum(max) of the weights, the
weighted Jaccard similarity, unbiased.

Signatures are cut into bands; documents that share a band are compared, and
pairs whose true multiset overlap is ``THRESHOLD`` or more are links. Equal texts
are one node from the start. In each band bucket the document with the
most bucket mates is compared with all others first; links join classes, and
only members of different classes go on, against the next 64 members of the
bucket. What is left then, buckets that still hold different classes, is dealt into
blocks of bounded size and compared in pairs of blocks. A class too large for one block
has blocks of its own, and two blocks of one class are no pair, so a large class
next to a few strangers costs its own size and not its square. No
pair that shares a band, passes the sieve of slot bits below and ends in
different classes is left uncompared, and nothing is capped. In the first two turns a pair is looked at in the bucket of its first common band only.
Before the true overlap, two bits of each slot (twice as many as the bands use) are
compared: a pair at the threshold differs in 3/20 of the slots, and a pair
``DEVIATIONS`` standard deviations beyond that is none (chance 1.3e-6 at the
threshold, 4e-12 at 0.84). From the second turn on a row carries its multiset to
the bucket and the true overlap is tested there, so that a group of copies
that are alike, but not enough, sends rows and not pairs. Blocks need no sieve: the common elements of all
their pairs are one matrix product, and a pair of blocks answers with
the links that join its classes, fewer than it has rows. A very long text is a block of its own and needs
memory in proportion to its words.

Recall: a pair of similarity 0.8 shares one of 36 bands of 7 with probability
0.9998, one of 0.85 with 0.999999; the sieve adds 1.3e-6 to the loss of 2.1e-4
at 0.8, and less above.

Null texts are empty; documents without words are classes of their own. Rows
with equal ids and different texts are different documents of the same id. A
class is named by its least id, null ids apart; ``kept`` is true for rows of that id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm import vec
from rateflow.llm.common import free_names, id_and_text, materialize, new_run_folder, null_ids_back, read, ship, text_chunks
from rateflow.llm.components import components_of, stored_edges

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 7
DEVIATIONS = 5
#: How many members a bucket compares with all others in each turn; the rest goes on in blocks.
PIVOTS = (1, 64)
#: Rows and shingles of a block (on average; rows are dealt by hash), and columns of the matrix product at once.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 256, 1 << 18, 4096
#: Bytes and documents sketched at once: a document draws some ten points a slot, however short it is.
CHUNK, CHUNK_DOCS = 2 << 20, 256
#: Weighted points of a document expected below its first time limit, beyond the slots' share.
SLACK = 4.0

_G, _H, _K = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_UNIT = 2.0**-53


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document index) of every shingle; a document of fewer words is one shingle."""
    starts, ends, bounds = vec.word_bounds(buf, offsets)
    words = vec.word_hashes(buf, starts, ends)
    hashes = vec.join_hashes(words, size)
    doc = np.searchsorted(bounds, np.arange(len(hashes)), "right") - 1
    inside = np.arange(len(hashes)) + size <= bounds[doc + 1]
    hashes, doc = hashes[inside], doc[inside]
    length = np.diff(bounds)
    short = np.flatnonzero((length > 0) & (length < size))
    extra = np.array([vec.join_hashes(words[bounds[i] : bounds[i + 1]], int(length[i]))[0] for i in short], np.uint64)
    return np.concatenate([hashes, extra]), np.concatenate([doc, short])


def weighted(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, document) with their counts, by document."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    head = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, np.int64)
    return hashes[head], doc[head], np.diff(np.append(head, len(doc)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def signatures(hashes: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, slots: int) -> np.ndarray:
    """Earliest point of each slot, one row per document; rows of documents without shingles stay infinite."""
    out = np.full((n_docs, slots), np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = slots * (np.log(slots) + SLACK) / np.maximum(total, 1)
    # One cell for each dyadic interval that a weight reaches into.
    levels = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    element = np.repeat(np.arange(len(hashes)), levels)
    level = np.arange(len(element)) - np.repeat(np.cumsum(levels) - levels, levels)
    length = np.where(level > 0, 1 << np.maximum(level - 1, 0), 1)
    below = weight[element] - np.where(level > 0, length, 0)  # cells of the interval that the weight covers
    seed = vec.mix(hashes[element] + level.astype(np.uint64) * _G)
    owner = doc[element]
    todo = np.flatnonzero(total > 0)
    while len(todo):
        wanted = np.zeros(n_docs, bool)
        wanted[todo] = True
        live = np.flatnonzero(wanted[owner])
        _fill(out, seed[live], owner[live], length[live], below[live], limit, slots)
        todo = todo[~(out[todo].max(axis=1) <= limit[todo])]
        limit[todo] *= 2
        out[todo] = np.inf
    return out


def _fill(out: np.ndarray, seed: np.ndarray, owner: np.ndarray, length: np.ndarray, below: np.ndarray, limit: np.ndarray, slots: int) -> None:
    """Run every cell's process up to its document's time limit."""
    flat = out.reshape(-1)
    time = np.zeros(len(seed))
    drawn, block = 0, 2
    while len(seed):
        number = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64)
        point = vec.mix(seed[:, None] + number * _H)
        at = time[:, None] + np.cumsum(-np.log(_uniform(point)), axis=1) / length[:, None]
        early = at <= limit[owner][:, None]
        which, column = np.nonzero(early)
        place = vec.mix(point[which, column] ^ _K)
        cell = ((place >> np.uint64(32)).astype(np.float64) * 2.0**-32 * length[which]).astype(np.int64)  # the halvings of the interval
        counts = cell < below[which]
        which, column, place = which[counts], column[counts], place[counts]
        slot = ((place & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(flat, owner[which] * slots + slot, at[which, column])
        going = early[:, -1]
        seed, owner, length, below, time = seed[going], owner[going], length[going], below[going], at[going, -1]
        drawn, block = drawn + block, 16


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _G, (len(signature), bands)).copy()
    for r in range(rows):
        key = vec.mix(key * _H + bits[:, :, r])
    return key


def slot_bits(signature: np.ndarray) -> np.ndarray:
    """Two bits of each slot, 32 slots in a 64-bit word."""
    some = vec.mix(np.ascontiguousarray(signature).view(np.uint64)) & np.uint64(3)
    wide = np.zeros((len(some), -(-some.shape[1] // 32) * 32), np.uint64)
    wide[:, : some.shape[1]] = some
    shifted = wide.reshape(len(some), -1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(shifted, axis=2).view(np.int64)


def differing_slots(a: Column, b: Column) -> Column:
    """In how many of a word's 32 slots two documents differ."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def most_different(slots: int, threshold: float) -> int:
    """Slots in which a pair at the threshold differs, up to DEVIATIONS."""
    p = (1 - threshold) * 3 / 4
    return int(slots * p + DEVIATIONS * np.sqrt(slots * p * (1 - p)))


def elements(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A multiset as a set of 32-bit hashes: the k-th copy of a shingle is an element of its own.

    Two unlike elements of a pair of documents are taken for equal with chance
    2**-32 each, far below one element in a document.
    """
    n = int(weight.sum())
    copy = np.arange(n) - np.repeat(np.cumsum(weight) - weight, weight)
    return (vec.mix(np.repeat(hashes, weight) + copy.astype(np.uint64) * _K) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _text_keys(buf: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    return [hashlib.md5(buf[a:e]).digest() for a, e in zip(offsets[:-1], offsets[1:])]


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, node, n, bands, bits): the text's digest, its number of shingles (0: no words), its band keys and slot bits."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, buf, offsets in text_chunks(batch, CHUNK, rows=CHUNK_DOCS):
                hashes, doc, weight = weighted(*shingles(buf, offsets))
                n = np.bincount(doc, weights=weight, minlength=len(ids)).astype(np.int64)
                signature = signatures(hashes, doc, weight, len(ids), 2 * bands * rows)
                keys, bits = band_keys(np.ascontiguousarray(signature[:, : bands * rows]), bands, rows), slot_bits(signature)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": null_ids_back(ids), "node": _text_keys(buf, offsets), "n": n,
                    "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * bands, pa.int32()), pa.array(keys.ravel().view(np.int64))),
                    "bits": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * bits.shape[1], pa.int32()), pa.array(bits.ravel())),
                })

    return docs.mapInArrow(run, "doc_id bigint, node binary, n bigint, bands array<bigint>, bits array<bigint>")


def multisets(docs: DataFrame) -> DataFrame:
    """(node, els): the shingle multiset of each text as a set of elements."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, buf, offsets in text_chunks(batch, CHUNK, rows=CHUNK_DOCS):
                hashes, doc, weight = weighted(*shingles(buf, offsets))
                n = np.bincount(doc, weights=weight, minlength=len(ids)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "node": _text_keys(buf, offsets),
                    "els": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(elements(hashes, weight))),
                })

    return docs.mapInArrow(run, "node binary, els array<int>")


def overlap(ea: str, eb: str, threshold: float) -> Column:
    """Whether two multisets overlap by ``threshold`` or more; the common elements are counted once."""
    both = F.array(F.size(F.array_intersect(ea, eb)))
    return F.exists(both, lambda common: common >= threshold * (F.size(ea) + F.size(eb) - common))


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b), those whose multisets overlap by ``threshold`` or more."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("els").alias("ea")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("els").alias("eb")), "b")
    return two.where(overlap("ea", "eb", threshold)).select(*pairs.columns)


def common_elements(els: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each row of ``left`` has in common with each of ``right``."""
    size = np.fromiter(map(len, els), np.int64, len(els))
    column = np.unique(np.concatenate(els), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    column, row = column[order], np.repeat(np.arange(len(els)), size)[order]
    out = np.zeros((len(left), len(right)), np.int64)
    cuts = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + COLUMNS + 1, COLUMNS))
    for k, (a, e) in enumerate(zip(cuts[:-1], cuts[1:])):
        has = np.zeros((len(els), COLUMNS), np.float32)
        has[row[a:e], column[a:e] - k * COLUMNS] = 1
        out += (has[left] @ has[right].T).astype(np.int64)
    return out


def _joining(pairs: np.ndarray, n: int) -> list[int]:
    """Positions of the pairs that join two parts of n things, taken in order."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, (x, y) in enumerate(pairs.tolist()):
        x, y = top(x), top(y)
        if x != y:
            root[x] = y
            out.append(i)
    return out


def compare_blocks(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(ca, cb): links that join the classes of two blocks (``right`` tells which), or of one block with itself."""
    code, names = pd.factorize(rows["component"])
    els = [np.asarray(x, np.int32) for x in rows["els"]]
    right = np.flatnonzero(rows["right"].to_numpy(bool))
    left = np.flatnonzero(~rows["right"].to_numpy(bool))
    right = right if len(right) else left
    size = np.fromiter(map(len, els), np.int64, len(els))
    common = common_elements(els, left, right)
    linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common)
    a, b = np.nonzero(linked & (code[left][:, None] != code[right][None, :]))
    pairs = np.unique(np.column_stack([code[left][a], code[right][b]]), axis=0)
    pairs = pairs[_joining(pairs, len(names))]
    return pd.DataFrame({"ca": [names[x] for x in pairs[:, 0]], "cb": [names[x] for x in pairs[:, 1]]}, dtype=object)


def block_links(rows: DataFrame, sets: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(ca, cb): links between the classes of each bucket; ``rows`` has key, node, n and component.

    Within a bucket, a class above a block's size is dealt over blocks of its own by
    node; all others share blocks, dealt by class. Sizes are grouped sums, so no task holds a bucket.
    """
    ship(rows.sparkSession)
    rows = rows.select("key", "node", "n", "component")
    weight = F.col("n") * block_rows + block_shingles  # whole numbers: their sum is the same whenever it is computed
    full = block_rows * block_shingles
    classes = rows.groupBy("key", "component").agg(F.sum(weight).alias("weight")).withColumn("own", F.ceil(F.col("weight") / full))
    shared = classes.where("own = 1").groupBy("key").agg(F.ceil(F.sum("weight") / full).alias("shared"))
    alone = F.col("own") > 1
    dealt = classes.join(shared, "key", "left").select(
        "key", "component", "own",
        F.when(alone, F.col("component")).otherwise(F.lit(b"")).alias("owner"),
        F.when(~alone, F.pmod(F.xxhash64("component"), F.col("shared"))).alias("part"),
    )
    parts = dealt.select("key", "owner", F.explode(F.when(alone, F.sequence(F.lit(0).cast("bigint"), F.col("own") - 1)).otherwise(F.array("part"))).alias("part"))
    blocks = parts.distinct().select("key", F.struct("owner", "part").alias("block"))
    met = blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), "key")
    met = met.where((F.col("x") <= F.col("y")) & ((F.col("x.owner") != F.col("y.owner")) | (F.col("x.owner") == F.lit(b""))))
    sides = F.array(F.struct(F.col("x").alias("block"), F.lit(False).alias("right")), F.struct(F.col("y").alias("block"), F.lit(True).alias("right")))
    ends = met.select("key", "x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.slice(sides, 1, 1)).otherwise(sides)).alias("end"))
    ends = ends.select("key", "x", "y", "end.block.owner", "end.block.part", "end.right")
    part = F.coalesce("part", F.pmod(F.xxhash64("node"), F.col("own")))
    placed = rows.join(dealt, ["key", "component"]).select("key", "node", "component", "owner", part.alias("part"))
    sent = placed.join(sets.select("node", "els"), "node").join(ends, ["key", "owner", "part"])
    return sent.groupBy("key", "x", "y").applyInPandas(lambda found: compare_blocks(found, threshold), "ca binary, cb binary")


def near_classes(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, cluster_id, kept): each row with the least id of its class of near duplicates."""
    out = _labelled(docs, threshold, bands, rows, id_col, text_col).select("doc_id", "cluster_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("cluster_id")))


def text_digest(text: Column) -> Column:
    """The node of a text: the digest of its UTF-8 bytes; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one row of each class: the least (id, text digest), of rows equal in both the one whose other columns come first as JSON.

    A null id comes after all others. Rows without words all stay, but for rows equal in id and text.
    """
    own_name, id_name, node_name, place = free_names(docs, "own", "id", "node", "place")
    found = _labelled(docs, threshold, bands, rows, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias(id_name), F.col("node").alias(node_name))).alias("first")
    chosen = found.where("n > 0").groupBy("component").agg(first).select(f"first.{id_name}", f"first.{node_name}")
    wordless = found.where("n = 0").select(F.col("doc_id").alias(id_name), F.col("node").alias(node_name)).distinct()
    own = docs.withColumn(own_name, text_digest(docs[text_col]))
    wanted = chosen.unionByName(wordless)
    joined = own.join(wanted, own[id_col].cast("bigint").eqNullSafe(F.col(id_name)) & (F.col(own_name) == F.col(node_name)))
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    first_row = Window.partitionBy(id_name, node_name).orderBy(F.to_json(F.struct(*others)))
    return joined.withColumn(place, F.row_number().over(first_row)).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def _labelled(docs: DataFrame, threshold: float, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, node, n, component, cluster_id) of every row; component is null where n is 0."""
    spark = docs.sparkSession
    folder = new_run_folder(spark)
    texts = id_and_text(docs, id_col, text_col)
    sketches = materialize(sketch(texts, bands, rows), folder, "sketches")
    worded = sketches.where("n > 0")
    nodes = worded.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    spread = materialize(nodes, folder, "nodes").select("node", F.posexplode("bands").alias("band", "key"))
    sizes = spread.groupBy("key").agg(F.count("*").alias("mates")).where("mates > 1")
    members = materialize(spread.join(sizes, "key"), folder, "members")
    nodes = spark.read.parquet(f"{folder}/nodes")

    words = [F.col("bits")[i].alias(f"s{i}") for i in range(-(-2 * bands * rows // 32))]
    half_keys = F.transform("bands", lambda k: F.shiftright(k, 32).cast("int")).alias("half_keys")
    carried = ["n", "half_keys", *(f"s{i}" for i in range(len(words)))]
    rank = members.groupBy("node").agg(F.sum("mates").alias("degree"))
    about = materialize(rank.join(nodes.select("node", "least_id", "n", half_keys, *words), "node"), folder, "about")
    chosen = about.select(F.coalesce("least_id", F.lit(-(1 << 63))).alias("chosen_id"), F.col("node").alias("want"))
    source = texts.join(chosen, F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("chosen_id"))
    source = source.where(text_digest(F.col("text")) == F.col("want")).select("doc_id", "text")
    sets = materialize(multisets(source).dropDuplicates(["node"]), folder, "sets")

    open_rows = members.join(about, "node").select("key", "band", "node", "degree", *carried)
    classes = about.select("node", F.col("node").alias("component"))
    best_first = Window.partitionBy("key").orderBy(F.desc("degree"), "node")
    for turn, pivots in enumerate((*PIVOTS, None)):
        if turn == 0:
            here = open_rows.withColumn("component", F.col("node"))  # every node is a class of its own, and no bucket holds just one
        else:
            here = open_rows.join(classes, "node")
            mixed = here.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
            here = here.join(mixed, "key", "left_semi")
        here = materialize(here, folder, f"open-{turn}")
        if here.isEmpty():
            break
        if pivots is None:
            links = block_links(here, sets, threshold)
        else:
            first = here.withColumn("turn", F.row_number().over(best_first)).where(F.col("turn") <= pivots).drop("turn")
            first = materialize(first, folder, f"pivots-{turn}")
            pivot = first.select("key", *[F.col(c).alias(f"p_{c}") for c in ("node", "degree", "component", *carried)])
            later = (F.col("degree") < F.col("p_degree")) | ((F.col("degree") == F.col("p_degree")) & (F.col("node") > F.col("p_node")))
            alike = F.least("n", "p_n") >= threshold * F.greatest("n", "p_n")
            differ = [differing_slots(F.col(c), F.col(f"p_{c}")) for c in carried[2:]]
            most = most_different(2 * bands * rows, threshold)
            # Documents that have little in common differ in too many of the first slots already.
            sieve = (sum(differ[: len(differ) // 2], F.lit(0)) <= most) & (sum(differ, F.lit(0)) <= most)
            before = (F.slice(c, 1, F.col("band")) for c in ("half_keys", "p_half_keys"))
            met = F.exists(F.zip_with(*before, lambda x, y: x == y), lambda z: z)
            wanted = later & (F.col("component") != F.col("p_component")) & alike & sieve & ~met
            ends = [F.col("component").alias("ca"), F.col("p_component").alias("cb")]
            if turn == 0:
                # One pivot a bucket: a member has a few pairs at most, and most rows go no further.
                links = verify(here.join(pivot, "key").where(wanted).select(F.col("node").alias("a"), F.col("p_node").alias("b"), *ends), sets, threshold)
            else:
                # Few rows are still open, but pairs grow with their number times the pivots: each row brings its
                # multiset to the bucket once, and the overlap is tested where the pair is met.
                mine, its = sets.select("node", "els"), sets.select(F.col("node").alias("p_node"), F.col("els").alias("p_els"))
                met_here = here.join(mine, "node").join(pivot.join(its, "p_node"), "key")
                links = met_here.where(wanted & overlap("els", "p_els", threshold)).select(*ends)
        edges = stored_edges(links, f"{folder}/turn-{turn}", "ca", "cb")
        if not edges.isEmpty():
            merged = components_of(edges, f"{folder}/turn-{turn}").select(F.col("node").alias("old"), F.col("component").alias("new"))
            joined = classes.join(merged, F.col("component") == F.col("old"), "left")
            classes = materialize(joined.select("node", F.coalesce("new", "component").alias("component")), folder, f"classes-{turn}")
        if pivots is not None:
            open_rows = here.drop("component").join(first.select("key", "node"), ["key", "node"], "left_anti")
    least = nodes.select("node", "least_id").join(classes, "node")
    named = least.join(least.groupBy("component").agg(F.min("least_id").alias("class_id")), "component").select("node", "component", "class_id")
    label = nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"), F.coalesce("class_id", "least_id").alias("class_id"))
    out = sketches.select("doc_id", "node", "n").join(label, "node", "left")
    return out.withColumn("cluster_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id"))).drop("class_id")


def op9_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates of ``documents``."""
    return near_classes(read(spark, sf_dir, "documents"))
