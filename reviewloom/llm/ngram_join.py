"""Near-duplicate texts: a Jaccard join of word n-grams by MinHash bands."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.batches import runs, small_batches
from reviewloom.llm.components import components
from reviewloom.llm.licenses import NORMAL
from reviewloom.llm.near_vectors import Forest
from reviewloom.session import materialize

TOGETHER = 1 << 18  # bytes of text hashed at once, or one longer text
PIECE = 1 << 19  # bytes of a long text's words hashed at once
MOST_HASHES = 128


def bands_and_rows(least: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows a band, and the bands, of at most ``most`` hashes that reach ``recall`` at ``least``."""
    for r in range(most, 0, -1):
        b = most // r
        if 1 - (1 - least**r) ** b >= recall:
            return b, r
    raise ValueError(f"{most} hashes do not reach recall {recall} at similarity {least}")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """Hashes of the n-grams of many texts at once."""

    def __init__(self, n: int):
        self.n = n
        self.byte = _numbers(1, 256)
        self.byte[32] = 0
        self.base = np.uint64(_numbers(2, 1)[0])
        self.powers = np.ones(1, np.uint64)
        self.place = _numbers(3, n)

    def _power(self, n: int) -> np.ndarray:
        while len(self.powers) < n:
            step = self.powers[-1:] * self.base  # an array, whose products wrap silently
            self.powers = np.append(self.powers, self.powers * step)
        return self.powers

    def sets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct n-gram hashes of all texts in a row, and where each text's begin and end."""
        blob = b"  ".join([t.translate(NORMAL) for t in texts]) + b" "
        raw = np.frombuffer(blob, np.uint8)
        is_word = raw != 32
        edge = np.diff(is_word.astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text_starts = np.cumsum([0] + [len(t) + 2 for t in texts])
        first_word = np.searchsorted(starts, text_starts)
        if len(starts):
            power = self._power(int((ends - starts).max()) + 1)
            words = np.empty(len(starts), np.uint64)
            # a long text's words are hashed in pieces of some of its bytes
            cuts = np.unique(np.searchsorted(starts, np.arange(starts[0], len(raw) + PIECE, PIECE)))
            for a, z in zip(cuts[:-1], cuts[1:]):
                first, last = starts[a], starts[z] if z < len(starts) else len(raw)
                own = (starts[a:z] - first).astype(np.int32)
                at = np.arange(last - first, dtype=np.int32) - np.repeat(own, np.diff(own, append=last - first))
                value = self.byte[raw[first:last]] * power[np.minimum(at, len(power) - 1)]
                words[a:z] = np.add.reduceat(value, own)
            words = _mixed(words + (ends - starts).astype(np.uint64))
        else:
            words = np.zeros(0, np.uint64)
        n = self.n
        grams = np.zeros(max(len(words) - n + 1, 0), np.uint64)
        for i in range(n):
            grams += words[i : i + len(grams)] * self.place[i]
        grams = _mixed(grams)
        out, bounds = [], [0]
        for i, t in enumerate(texts):
            a, z = first_word[i], first_word[i + 1]
            if z - a >= n:
                own = np.unique(grams[a : z - n + 1])
            elif z > a:  # fewer words than n: all of them are the one n-gram
                own = _mixed((words[a:z] * self.place[: z - a]).sum(keepdims=True) + np.uint64(z - a))
            elif t.strip():  # no word at all: the bytes themselves
                bare = t.strip()
                raw_hash = np.frombuffer(bare.ljust(-(-len(bare) // 8) * 8, b"\0"), np.uint64)
                mixed = _mixed(raw_hash + np.arange(len(raw_hash), dtype=np.uint64))
                own = _mixed(mixed.sum(keepdims=True) + np.uint64(len(bare)))
            else:
                own = np.zeros(0, np.uint64)
            out.append(own)
            bounds.append(bounds[-1] + len(own))
        return np.concatenate(out) if out else np.zeros(0, np.uint64), np.array(bounds)


def _groups(texts: list[bytes]) -> Iterable[list[bytes]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size > TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _sign(hashes: np.ndarray, bounds: np.ndarray, b: int, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Per set: a hash for each band, and a byte of each MinHash for estimates. Sets are not empty."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    factor = (_numbers(4, b * r) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    salt = (_numbers(5, b * r) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(bounds) - 1, b * r), np.uint32)
    for j in range(b * r):
        least[:, j] = np.minimum.reduceat((short ^ salt[j]) * factor[j], bounds[:-1])
    wide = least.astype(np.uint64).reshape(-1, b, r)
    band = np.zeros(wide.shape[:2], np.uint64) + np.arange(1, b + 1, dtype=np.uint64)
    for j in range(r):
        band = _mixed(band * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, j])
    return band.view(np.int64), (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)


def _signatures(docs: DataFrame, n: int, b: int, r: int) -> DataFrame:
    """(row, id, text_key, h1, h2, n, bands, sketch) per document; h1 is null without n-grams."""

    def run(batches: Iterable[pa.RecordBatch]):
        shingles = Shingles(n)
        for batch in batches:
            texts = [t or b"" for t in batch.column(3).cast(pa.binary()).to_pylist()]
            at = 0
            for group in _groups(texts):
                hashes, bounds = shingles.sets(group)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                band, sketch = np.zeros((len(group), b), np.int64), np.zeros((len(group), b * r), np.uint8)
                h1, h2 = np.zeros(len(group), np.uint64), np.zeros(len(group), np.uint64)
                if len(full):
                    kept = np.append(bounds[:-1][full], bounds[-1])
                    band[full], sketch[full] = _sign(hashes, kept, b, r)
                    h1[full] = _mixed(np.add.reduceat(hashes, kept[:-1]) + size[full].astype(np.uint64))
                    h2[full] = np.add.reduceat(_mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), kept[:-1])
                none = size == 0
                rows = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        rows.column(2),
                        pa.array(h1.view(np.int64), mask=none),
                        pa.array(h2.view(np.int64), mask=none),
                        pa.array(size),
                        pa.array(list(band), pa.list_(pa.int64())),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    ["row", "id", "text_key", "h1", "h2", "n", "bands", "sketch"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    made = small_batches(docs).select(F.monotonically_increasing_id().alias("row"), "id", "text_key", "text").mapInArrow(
        run, f"row long, id {kind}, text_key long, h1 long, h2 long, n long, bands array<long>, sketch binary"
    )
    return materialize(made, "signatures")


def _alike(b: int, r: int, least: float):
    """Maps runs of a bucket's rows to a forest of pairs whose estimated similarity is ``least``.

    Rows join the tree of the first one they resemble, and are then compared with the rest in turn,
    so every pair that reaches the estimate ends in one tree without being written. All rows of a
    tree hang on its first, which saves rounds when the buckets' trees are put together.
    """
    width, wanted = b * r, int(np.ceil(least * b * r))

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in runs(batches, "bucket"):
            keys = batch.column(0).to_numpy()
            rows = batch.column(1).to_numpy()
            sketch = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, width)
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(keys)) + 1), len(keys))
            out: list[tuple[int, int]] = []
            for a, z in zip(cuts[:-1], cuts[1:]):
                rest = np.arange(a, z)
                while len(rest) > 1:
                    root, tree, rest = rows[rest[0]], [rest[0]], rest[1:]
                    while tree and len(rest):
                        near = (sketch[rest] == sketch[tree.pop()]).sum(1) >= wanted
                        out += [(root, rows[x]) for x in rest[near]]
                        tree += rest[near].tolist()
                        rest = rest[~near]
            if out:
                left, right = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["x", "y"])

    return run


def _in_blocks(df: DataFrame, key: str, n_blocks: str, carry: list[str]) -> DataFrame:
    """Rows dealt to the pairs i <= j of their key's blocks, so no group holds more than two blocks."""
    block = F.pmod(F.xxhash64("row"), F.col(n_blocks)).alias("block")
    other = df.select("*", block).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_blocks) - 1)))
    return other.select(
        key, F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "row", *carry
    )


def _candidates(reps: DataFrame, b: int, r: int, estimate: float, block: int) -> DataFrame:
    """(x, y): a forest over the rows that meet in some band and whose estimate is high enough."""
    banded = reps.select("row", F.explode("bands").alias("bucket"))
    several = (
        banded.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("bucket", F.ceil(F.col("n") / block).alias("n_blocks"))
    )
    met = _in_blocks(banded.join(several, "bucket"), "bucket", "n_blocks", [])
    met = met.select(F.xxhash64("bucket", "i", "j").alias("bucket"), "row")
    sketched = met.join(reps.select("row", "sketch"), "row").select("bucket", "row", "sketch")
    dealt = sketched.repartition("bucket").sortWithinPartitions("bucket", "row")
    return dealt.mapInArrow(_alike(b, r, estimate), "x long, y long")


def _verify(least: float):
    """Maps one pair of blocks to each row's number of links there, and a forest of the links."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        order = np.lexsort((group["row"].to_numpy(), group["block"].to_numpy()))
        rows, block = group["row"].to_numpy()[order], group["block"].to_numpy()[order]
        weight = group["weight"].to_numpy()[order]
        sets = group["grams"].take(pa.array(order)).to_pylist()
        sizes = np.array([len(s) // 8 for s in sets])
        grams, column = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), sizes)
        # n-grams of one row alone add to no intersection
        shared = np.bincount(column, minlength=len(grams)) > 1
        column = np.cumsum(shared)[column] * shared[column] - 1
        owner, column = owner[column >= 0], column[column >= 0]
        by_column = np.argsort(column, kind="stable")
        owner, column = owner[by_column], column[by_column]
        common = np.zeros((len(rows), len(rows)), np.float32)
        step = 2048
        edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + step, step))
        for part, (a, z) in enumerate(zip(edges[:-1], edges[1:])):
            here = np.zeros((len(rows), step), np.float32)
            here[owner[a:z], column[a:z] - part * step] = 1
            common += here @ here.T
        near = np.empty(common.shape, bool)
        for a in range(0, len(rows), 256):
            part = common[a : a + 256].astype(np.float64)
            near[a : a + 256] = part / (sizes[a : a + 256, None] + sizes[None, :] - part) >= least
        np.fill_diagonal(near, False)
        if i != j:  # pairs within a block are another group's
            near &= block[:, None] != block[None, :]
        forest = Forest(len(rows))
        for x in np.flatnonzero(near.any(1)):
            forest.join(x, np.flatnonzero(near[x]))
        count = near @ weight
        hit = np.flatnonzero(count)
        return pa.table({"row": rows[hit], "n": count[hit], "root": rows[forest.roots()[hit]]})

    return compare


def join(
    df: DataFrame,
    least: float = 0.8,
    words: int = 5,
    recall: float = 0.999,
    margin: float = 0.2,
    key: str = "doc_id",
    text: str = "text",
    bucket_block: int = 8192,
    block: int = 1024,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key``, ``n_links``, ``component_id`` and ``kept``.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word n-grams is
    at least ``least``. Words are runs of digits, letters and non-ASCII characters, with A-Z as
    a-z. Documents with the same set are folded into one weighted row. MinHash signatures are cut
    into bands, whose number and rows are chosen so that a pair at ``least`` meets in some band
    with probability ``recall`` or more; rows are shuffled by band hash. Within a bucket, rows
    whose estimated similarity is ``least - margin`` (five standard errors lower) form trees; the
    trees of all buckets give candidate groups, and in each group every pair is verified on the
    full n-gram sets. Buckets and groups are cut into blocks and compared block by block, so none
    needs a task of its own; what leaves a block is counts and a forest of links, not pairs.

    ``n_links`` counts the other documents linked directly, copies included; ``component_id`` is
    the smallest id reachable by links; ``kept`` marks one row of each component, the one with the
    smallest id (of rows with that id, the first). A text of fewer words is one n-gram of all its
    words; one without words is compared as it is; null, empty and blank texts link with nothing.
    Rows with a null id take part; a component of such rows alone has a null id, and one is kept.
    ``text_key`` is a hash of the text, to find the row again. Other columns are not read; an empty
    table gives no rows.
    """
    b, r = bands_and_rows(least, recall)
    docs = df.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    signed = _signatures(docs, words, b, r)
    folded = materialize(
        signed.filter("h1 is not null")
        .groupBy("h1", "h2")
        .agg(
            F.min("row").alias("row"),
            F.count("*").alias("weight"),
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"),
        ),
        "folded",
    )
    reps = signed.join(folded.select("row"), "row", "left_semi").select("row", "bands", "sketch")
    groups = components(_candidates(reps, b, r, least - margin, bucket_block))
    members = materialize(
        groups.select(F.col("node").alias("row"), "component")
        .union(groups.select("component", "component").distinct())
        .join(folded.select("row", "weight"), "row")
        .join(signed.select("row", "id", "text_key", "n"), "row"),
        "members",
    )
    # The texts of candidates only are hashed again, for their whole sets. The candidates grow with
    # the corpus, so they are never broadcast: the plan is the same at every size.
    again = (
        docs.withColumnRenamed("id", "doc")
        .join(members.hint("merge"), "text_key")
        .filter(F.col("doc").eqNullSafe(F.col("id")))
    )
    again = again.groupBy("row", "component", "weight").agg(F.first("text").alias("text"))

    def grams(batches: Iterable[pa.RecordBatch]):
        shingles = Shingles(words)
        for batch in batches:
            at = 0
            for group in _groups([t or b"" for t in batch.column(3).cast(pa.binary()).to_pylist()]):
                hashes, bounds = shingles.sets(group)
                sets = [hashes[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
                rows = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(sets, pa.binary())],
                    ["row", "component", "weight", "grams"],
                )

    sets = again.mapInArrow(grams, "row long, component long, weight long, grams binary")
    sizes = members.groupBy("component").agg(
        F.ceil(F.greatest(F.count("*") / block, F.sum("n") / (block * 512))).alias("n_blocks")
    )
    found = materialize(
        _in_blocks(sets.join(sizes, "component"), "component", "n_blocks", ["weight", "grams"])
        .groupBy("component", "i", "j")
        .applyInArrow(_verify(least), "row long, n long, root long"),
        "verified",
    )
    links = found.groupBy("row").agg(F.sum("n").alias("_n"))
    classes = components(found.filter("row <> root").select("row", "root"))
    member = (
        folded.join(links, "row", "left")
        .join(classes.withColumnRenamed("node", "row"), "row", "left")
        .withColumn("component", F.coalesce("component", "row"))
    )
    firsts = member.groupBy("component").agg(F.min("first").alias("best"))
    member = member.join(firsts, "component").select(
        "h1", "h2", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "best"
    )
    return signed.select("row", "id", "text_key", "h1", "h2").join(member, ["h1", "h2"], "left").select(
        F.col("id").alias("doc_id"),
        "text_key",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``df`` with one document of each component of ``join``, all columns as they were.

    A row that occurs several times with the same key and text is kept once at most.
    """
    kept = join(df, key=key, text=text, **how).filter("kept").select("doc_id", "text_key")
    kept = kept.groupBy("doc_id", "text_key").count().select(
        F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")
    )
    keys = [F.col(key), F.xxhash64(text)]
    # all columns in one struct, so that none can clash with those needed here
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), keys[0].alias("_key"), keys[1].alias("_text_key"))
    once = Window.partitionBy("_key", "_text_key").orderBy("_key")
    rows = rows.withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    kept_rows = rows.join(
        kept, F.col("_key").eqNullSafe(F.col("_kept_id")) & (F.col("_text_key") == F.col("_kept_key")), "left_semi"
    )
    return kept_rows.select("_row.*")
