"""Similarity join of documents by the Jaccard similarity of their word shingles: a grouped prefix join.

1. Documents with identical sets collapse to one. Every shingle's document frequency is counted over all documents
   (chunks.py) and orders the shingles, rare ones first; shingles of one document only can link nothing.
2. A document's prefix is the first n - ceil(t n) + 1 shingles of that order; linked documents share one of their prefixes.
   What counts of it are the shingles that others have: most documents have none left and are done.
3. Documents with identical prefixes, sizes and numbers of shared shingles form a group. Each group is verified against its
   smallest member; members that are linked to it form a star, the others stand alone.
4. Stars and single documents are units, with the prefix of their group. A prefix shingle links its units to one leader
   first, then in lots of a few units to a leader of each lot, as long as that connects many: a thousand near copies become
   one component by some thousand comparisons, also where many of them are too far from any one leader. Shingles whose units
   are all in one component are left out from then on. Only units of different components still need a comparison. The
   postings of a shingle are contracted to one row per component with the bounds of its units (sizes, positions, outlines),
   components are paired by those, and pairs expanded to units that share the shingle, the smaller component first.
5. Of these pairs every unit first compares its most promising ones, a few, and what they connect needs no other pair; so
   on in waves, until few pairs of different components are left, which are all compared. These are comparisons of pivots.
   Only where they leave two units in different components are the members of stars compared, and of those only the ones
   that the triangle inequality of the Jaccard distance leaves. Before any verification, the outlines of both sets (shared
   shingles counted by hash cell) bound what they can have in common.
Links are merged into labels as they are found, between components and not between documents: of a thousand links between two
components one row is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import answered, buckets_for, pack, rows_by_bucket, squeezed, texts_of, unsqueezed
from .common import HEAVY_ROWS, MIDDLE_ROWS, gathered, let_go, written
from .components import components
from .substring_dedup import LOW, block_keys
from .words import mixed, rolling, word_hashes

#: Shingles before the current one that a posting carries, to see whether a pair was made already.
CARRIED = 4

#: Cells of an outline: shared shingles counted by hash.
CELLS = 128

#: Comparisons of a turn below which there is no other turn. A unit that a turn connects need not be compared with all the
#: units of its component; the result is the same with any number.
WORTH_A_TURN = 64

#: Units of a lot, about: what the leader of a later turn is compared with.
LOT = 8

#: Pairs that a unit has compared in a wave, and pairs below which there is no other wave. The result is the same with any number.
PROMISING, WORTH_A_WAVE = 4, 1024

PROFILE = "id long, n long, high long, low long, shared long, prefix array<long>, outline array<smallint>, held binary"


def sets_of(sizes: list[int], blob: bytes, words: int) -> list[np.ndarray]:
    """Sorted distinct shingles of every document of a chunk; A-Z lower-cased."""
    lists = [text.lower().split() for text in texts_of(sizes, blob)]
    lengths = np.array([len(w) for w in lists], np.int64)
    hashes = np.concatenate([word_hashes(w) for w in lists]) if lists else np.empty(0, np.uint64)
    grams, out, at = rolling(hashes, words), [], 0
    for n in lengths.tolist():
        if n >= words:
            out.append(np.unique(grams[at : at + n - words + 1]))
        else:
            out.append(rolling(hashes[at : at + n], n) if n else hashes[:0])
        at += n
    return out


class Shingles:
    """Frequency questions of a chunk."""

    def __init__(self, sets: list[np.ndarray], buckets: int):
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        self.keys = block_keys(flat, buckets)
        self.values, self.counts = np.unique(self.keys, return_counts=True)
        self.bucket = self.values >> np.uint64(32)

    def questions(self, chunk: int) -> Iterator[tuple]:
        columns = [(self.values & LOW).astype(np.uint32), self.counts.astype(np.uint32)]
        return rows_by_bucket(chunk, self.bucket, columns, [np.ndarray.tobytes, lambda c: squeezed(c.tobytes())])

    def frequency_classes(self, answers: list[dict] | None) -> np.ndarray:
        """For every shingle of every set: 0 if one document has it, else the bits of its document frequency."""
        if not len(self.values):
            return np.empty(0, np.uint8)
        by_bucket = {a["bucket"]: a["data"] for a in answers}
        present = np.unique(self.bucket).tolist()
        classes = np.concatenate([np.frombuffer(unsqueezed(by_bucket[b]), np.uint8) for b in present])
        return classes[np.searchsorted(self.values, self.keys)]


def frequency_answer(rows: list[tuple]) -> list[bytes]:
    """For (bucket, chunk, values, counts): the frequency class of each value."""
    sets = [np.frombuffer(row[2], np.uint32) for row in rows]
    counts = np.concatenate([np.frombuffer(unsqueezed(row[3]), np.uint32) for row in rows])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    total = np.bincount(place, counts).astype(np.int64)
    classes = np.where(total > 1, np.ceil(np.log2(total + 1)), 0).astype(np.uint8)
    return [squeezed(part.tobytes()) for part in np.split(classes[place], np.cumsum([len(s) for s in sets])[:-1])]


def profile(ident, shingles: np.ndarray, classes: np.ndarray, percent: int) -> tuple:
    """id, size, 128-bit digest, number of shared shingles; of them the prefix in order, the outline, and all of them."""
    n = len(shingles)
    high, low = (int(mixed(shingles ^ np.uint64(c)).sum(dtype=np.uint64).astype(np.int64)) for c in (0x5851F42D, 0x14057B7E))
    shared = classes > 0
    k = int(shared.sum())
    length = n - -(-n * percent // 100) + 1 - (n - k)  # of the prefix, without shingles of this document alone
    if n == 0 or length <= 0:
        return ident, n, high, low, k, None, None, None
    held = shingles[shared]
    prefix = held[np.lexsort((held, classes[shared]))][:length]
    outline = np.bincount((held >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS)
    outline = np.minimum(outline, 2**15 - 1).astype(np.int16) if outline.max() < 2**15 else None
    return ident, n, high, low, k, prefix.view(np.int64), outline, held.tobytes()


def outlines_share(outline_a: str, outline_b: str) -> Column:
    """The most that two sets have in common: the smaller count in every cell. Null without an outline."""
    least = F.zip_with(outline_a, outline_b, lambda a, b: F.least(a, b))
    return F.aggregate(least, F.lit(0), lambda total, cell: total + cell).cast("bigint")


def outlines_allow(n_a: str, outline_a: str, n_b: str, outline_b: str, percent: int):
    """Whether two sets may link by their outlines. Without one (a cell of a huge set is beyond 15 bits) they may."""
    most = outlines_share(outline_a, outline_b)
    return F.coalesce(most * (100 + percent) >= percent * (F.col(n_a) + F.col(n_b)), F.lit(True))


def shared_count(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with common, size_a and size_b: exact intersections of their sets."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("size_a"), F.col("held").alias("held_a"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("size_b"), F.col("held").alias("held_b"))
    joined = pairs.join(left, "a").join(right, "b")
    kept = [c for c in joined.columns if not c.startswith("held_")]
    schema = joined.select(*kept).schema.add("common", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            common = [
                shared_count(a.as_buffer(), b.as_buffer()) for a, b in zip(batch["held_a"], batch["held_b"], strict=True)
            ]
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(common, pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)


def _linked(percent: int):
    return F.col("common") * 100 >= percent * (F.col("size_a") + F.col("size_b") - F.col("common"))


def _distance():
    return 1 - F.col("common") / (F.col("size_a") + F.col("size_b") - F.col("common"))


def profiles(documents: DataFrame, percent: int, words: int, id_col: str, text_col: str) -> DataFrame:
    chunks = pack(documents, id_col, text_col)
    buckets = buckets_for(chunks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names, kinds = ["bucket", "chunk", "values", "counts"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                rows = list(Shingles(sets_of(row["sizes"], row["blob"], words), buckets).questions(row["chunk"]))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        names = ["id", "n", "high", "low", "shared", "prefix", "outline", "held"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int16()), pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                sets = sets_of(row["sizes"], row["blob"], words)
                classes = Shingles(sets, buckets).frequency_classes(row["answers"])
                parts = np.split(classes, np.cumsum([len(s) for s in sets])[:-1])
                rows = [profile(i, s, c, percent) for i, s, c in zip(row["ids"], sets, parts, strict=True)]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    asked = chunks.select("chunk", "sizes", "blob").mapInArrow(ask, "bucket int, chunk long, values binary, counts binary")
    answers = answered(asked, frequency_answer)
    return written(chunks.join(answers, "chunk", "left").mapInArrow(describe, PROFILE), "profiles")


def _most_outline() -> Column:
    """The cell-wise maximum of outlines, which bounds each of them; null if one is missing."""
    most = F.array(*[F.max(F.col("outline")[cell]) for cell in range(CELLS)])
    return F.when(F.count("outline") == F.count(F.lit(1)), most)


def _sizes_allow(n_a: str, rest_a: str, n_b: str, rest_b: str, percent: int) -> Column:
    """Whether units of these sizes may link that have so many shingles left from a common one on."""
    return (
        (F.col(n_a) * 100 >= percent * F.col(n_b))
        & (F.col(n_b) * 100 >= percent * F.col(n_a))
        & (F.least(rest_a, rest_b) * (100 + percent) >= percent * (F.col(n_a) + F.col(n_b)))
    )


def _labelled(rows: DataFrame, labels: DataFrame | None, unit: str = "u", name: str = "comp") -> DataFrame:
    """The component of each unit; units without links are their own."""
    if labels is None:
        return rows.withColumn(name, F.col(unit))
    known = labels.select(F.col("node").alias(unit), F.col("component").alias("_label"))
    return rows.join(known, unit, "left").withColumn(name, F.coalesce("_label", unit)).drop("_label")


def relabelled(labels: DataFrame | None, links: DataFrame, tried: int) -> DataFrame:
    """(node, component) of all that is linked, after further links (a, b), found among so many that were tried.

    What is linked already counts as one node, its component, so the work follows the components that meet.
    """
    before = 0 if labels is None else labels.count()
    ends = _labelled(_labelled(links.select("a", "b"), labels, "a", "x"), labels, "b", "y").filter("x <> y")
    ends = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    moved = components(written(gathered(ends, max(tried, before)), "ends"))
    if labels is None:
        return moved
    known = labels.join(moved.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    known = known.select("node", F.coalesce("now", "component").alias("component"))
    known = known.unionByName(moved.join(labels.select("node"), "node", "left_anti"))
    return written(gathered(known, before + 2 * tried), "all-labels")


def apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs (a, b, ...) of different components, with these as comp_a and comp_b."""
    known = pairs.drop("comp_a", "comp_b")
    return _labelled(_labelled(known, labels, "a", "comp_a"), labels, "b", "comp_b").filter("comp_a <> comp_b")


def promising(pairs: DataFrame) -> DataFrame:
    """(a, b): of the pairs (a, b, score) of every unit the best one of each of a few hash slots."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "score")
    both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "score"))
    slot = F.pmod(F.xxhash64("v"), F.lit(PROMISING)).alias("slot")
    best = both.groupBy("u", slot).agg(F.max_by("v", F.struct("score", "v")).alias("v"))
    return best.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def contested(placed: DataFrame) -> DataFrame:
    """Postings of shingles with units of several components, and how many units have the shingle."""
    found = placed.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("units"))
    return placed.drop("units").join(found.filter("low <> high").select("shingle", "units"), "shingle")


def leader_pairs(placed: DataFrame, units: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): units and a leader of one of their shingles, in another component.

    First all units of a shingle have one leader, so that families which share many shingles mostly share it. Later turns
    deal the units of every shingle to lots anew, so a unit meets as many leaders as it has shingles left.
    """
    lots = F.greatest(F.lit(1), F.floor(F.col("units") / LOT))
    dealt = placed.withColumn("lot", F.pmod(F.xxhash64(F.lit(turn), "shingle", "u"), lots) if turn else F.lit(0).cast("bigint"))
    order = F.struct(F.xxhash64("u", "shingle", F.lit(turn)), "u") if turn else F.struct(F.col("u"))
    leaders = dealt.groupBy("shingle", "lot").agg(F.min_by(F.struct("u", "n", "rest", "comp"), order).alias("leader"))
    leaders = leaders.select("shingle", "lot", *(F.col(f"leader.{c}").alias(f"{c}_l") for c in ("u", "n", "rest", "comp")))
    met = dealt.join(leaders, ["shingle", "lot"])
    met = met.filter((F.col("comp") != F.col("comp_l")) & _sizes_allow("n", "rest", "n_l", "rest_l", percent))
    pairs = met.select(F.least("u", "u_l").alias("a"), F.greatest("u", "u_l").alias("b")).distinct()
    a, b = (units.select(F.col("u").alias(s), F.col("n").alias(f"n_{s}"), F.col("outline").alias(f"o_{s}")) for s in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").filter(outlines_allow("n_a", "o_a", "n_b", "o_b", percent)).select("a", "b")


def component_pairs(placed: DataFrame, units: DataFrame, percent: int) -> DataFrame:
    """(a, b, score): all pairs of units in different components that share a prefix shingle and may hold a link.

    The score is the most that their outlines let them have in common, as a share of their union.
    """
    rows = max(placed.count(), units.count())
    pos = (F.col("shared") - F.col("rest")).cast("int")
    before = F.slice("prefix", 1, F.least(pos, F.lit(CARRIED))).alias("before")
    placed = contested(placed).join(units.select("u", "shared", "prefix", "outline"), "u")
    placed = placed.select("u", "comp", "n", "shingle", "rest", before, "outline")
    placed = written(gathered(placed, rows, MIDDLE_ROWS), "placed")
    bounds = placed.groupBy("shingle", "comp").agg(
        F.count(F.lit(1)).alias("units"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
        F.max("rest").alias("most"),
        _most_outline().alias("bound"),
    )
    bounds = written(gathered(bounds, rows, MIDDLE_ROWS), "contracted")
    names = ("comp", "units", "low", "high", "most", "bound")
    a = bounds.select("shingle", *(F.col(c).alias(f"{c}_a") for c in names))
    b = bounds.select("shingle", *(F.col(c).alias(f"{c}_b") for c in names))
    may = (
        (F.struct("units_a", "comp_a") < F.struct("units_b", "comp_b"))
        & (F.col("high_a") * 100 >= percent * F.col("low_b"))
        & (F.col("high_b") * 100 >= percent * F.col("low_a"))
        & (F.least("most_a", "most_b") * (100 + percent) >= percent * (F.col("low_a") + F.col("low_b")))
        & outlines_allow("low_a", "bound_a", "low_b", "bound_b", percent)
    )
    met = a.join(b, (a["shingle"] == b["shingle"]) & may)
    met = met.select(a["shingle"], "comp_a", "comp_b", "low_b", "high_b", "most_b", "bound_b")
    left, right = (
        placed.select(F.col("shingle").alias(f"shingle_{s}"), F.col("comp").alias(f"of_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in ("u", "n", "rest", "before", "outline")))
        for s in ("a", "b")
    )
    # a unit of the smaller component against the bounds of the other one, then against its units
    reaches = (
        (F.col("n_a") * 100 >= percent * F.col("low_b"))
        & (F.col("high_b") * 100 >= percent * F.col("n_a"))
        & (F.least("rest_a", "most_b") * (100 + percent) >= percent * (F.col("n_a") + F.col("low_b")))
        & outlines_allow("n_a", "outline_a", "low_b", "bound_b", percent)
    )
    half = met.join(left, (F.col("shingle") == F.col("shingle_a")) & (F.col("comp_a") == F.col("of_a")) & reaches)
    half = half.select("shingle", "comp_b", "u_a", "n_a", "rest_a", "before_a", "outline_a")
    fits = _sizes_allow("n_a", "rest_a", "n_b", "rest_b", percent) & ~F.arrays_overlap("before_a", "before_b")
    same = (F.col("shingle") == F.col("shingle_b")) & (F.col("comp_b") == F.col("of_b"))
    pairs = half.join(right, same & fits & outlines_allow("n_a", "outline_a", "n_b", "outline_b", percent))
    most = outlines_share("outline_a", "outline_b")
    score = F.coalesce(most / (F.col("n_a") + F.col("n_b") - most), F.lit(1.0)).alias("score")
    pairs = pairs.select(F.least("u_a", "u_b").alias("a"), F.greatest("u_a", "u_b").alias("b"), score).distinct()
    return written(gathered(pairs, rows, MIDDLE_ROWS), "candidates")


def jaccard_labels(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all sets that are linked with others, from distinct sets (id, n, shared, prefix, outline, held)."""
    spread = 1 - percent / 100
    key = F.struct(F.xxhash64("n", "shared", "prefix").alias("x"), F.xxhash64("prefix", "shared", "n").alias("y"))
    members = sets.select("id", "n", "shared", "prefix", "outline", key.alias("key"))
    same = [F.first(name).alias(name) for name in ("n", "shared", "prefix")]
    # the outline of a group bounds that of every member
    groups = members.groupBy("key").agg(F.min("id").alias("g"), *same, _most_outline().alias("outline"))
    rows = sets.count()
    groups = written(gathered(groups, rows), "groups")
    of = members.select("id", "key").join(groups.select("key", "g"), "key").select("id", "g")
    of = written(gathered(of, rows), "members")

    # stars: members against the smallest of their group
    star = verified(of.filter("id <> g").select(F.col("g").alias("a"), F.col("id").alias("b")), sets)
    star = written(gathered(star, rows, HEAVY_ROWS), "stars")
    inside = star.filter(_linked(percent))
    far = star.filter(~_linked(percent)).select(F.col("b").alias("pivot"), F.col("a").alias("g"))
    radius = inside.groupBy(F.col("a").alias("pivot")).agg(F.max(_distance()).alias("radius"))

    # units, each with the outline that bounds all that it stands for, and their postings
    heads = groups.select(F.col("g").alias("u"), "g", "n", "shared", "prefix", "outline")
    own = sets.select(F.col("id").alias("pivot"), "outline")
    others = far.join(own, "pivot").join(groups.select("g", "n", "shared", "prefix"), "g")
    units = heads.unionByName(others.withColumnRenamed("pivot", "u"))
    units = written(gathered(units, rows), "units")
    posts = units.select("u", "n", "shared", F.posexplode("prefix").alias("pos", "shingle"))
    placed = posts.select("u", "n", "shingle", (F.col("shared") - F.col("pos")).alias("rest"), F.col("u").alias("comp"))

    # leaders, as long as a turn compares much and connects most of it; all that is left is compared below
    labels, turn, going = None, 0, True
    posted = units.agg(F.sum(F.size("prefix"))).first()[0] or 0
    while going:
        placed = written(gathered(contested(placed), posted), "postings")
        posted = placed.count()
        met = written(gathered(leader_pairs(placed, units, turn, percent), max(posted, rows)), "leader-pairs")
        tried = written(gathered(verified(met, sets), max(met.count(), rows), HEAVY_ROWS), "led")
        total, linked = tried.agg(F.count(F.lit(1)), F.count_if(_linked(percent))).first()
        if linked:
            labels = relabelled(labels, tried.filter(_linked(percent)), total)
            placed = written(gathered(_labelled(placed.drop("comp"), labels), max(posted, labels.count())), "labelled")
        turn, going = turn + 1, total > WORTH_A_TURN and linked * 2 > total

    # waves of the most promising pairs, as long as they connect many; then all pairs that are left between components
    pairs, compared, waves = component_pairs(placed, units, percent), None, True
    while True:
        left = pairs.count()
        waves = waves and left > WORTH_A_WAVE
        tried = verified(promising(pairs) if waves else pairs.select("a", "b"), sets)
        tried = written(gathered(tried, max(left, rows), HEAVY_ROWS), "pivots")
        compared = tried if compared is None else compared.unionByName(tried)
        total, linked = tried.agg(F.count(F.lit(1)), F.count_if(_linked(percent))).first()
        if linked:
            labels = relabelled(labels, tried.filter(_linked(percent)), total)
        if not waves:
            break
        rest = apart(pairs, labels).select("a", "b", "score").join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs, waves = written(gathered(rest, max(left, rows)), "candidates"), linked * 16 > total

    # members of stars where the pivots are not linked, nor connected by others; a pivot of a star is compared with the
    # members of the other unit, a member that missed its pivot is in a unit of its own and was compared with that pivot already
    missed = star.filter(~_linked(percent)).select("a", "b", _distance().alias("gap"))
    gap = compared.filter(~_linked(percent)).select("a", "b", _distance().alias("gap")).unionByName(missed).distinct()
    gap = written(gathered(apart(gap, labels), rows + compared.count()), "gaps")
    wide = gap.join(radius.select(F.col("pivot").alias("a"), F.col("radius").alias("ra")), "a", "left").join(
        radius.select(F.col("pivot").alias("b"), F.col("radius").alias("rb")), "b", "left"
    )
    wide = wide.filter(
        (F.col("ra").isNotNull() | F.col("rb").isNotNull())
        & (F.coalesce("ra", F.lit(0.0)) + F.coalesce("rb", F.lit(0.0)) + spread + 1e-9 >= F.col("gap"))
    )
    wide = written(wide.select("a", "b", "gap"), "wide")
    outlines = sets.select("id", "n", "outline")
    reach = inside.select(F.col("a").alias("pivot"), F.col("b").alias("member"), _distance().alias("d"))
    reach = reach.unionByName(units.select(F.col("u").alias("pivot"), F.col("u").alias("member"), F.lit(0.0).alias("d")))
    asked = wide.select(F.col("a").alias("pivot")).unionByName(wide.select(F.col("b").alias("pivot")))
    reach = reach.join(asked, "pivot", "left_semi").join(outlines.withColumnRenamed("id", "member"), "member")
    # a set is a member once and a pivot once at most
    reach = written(gathered(reach, 2 * rows, MIDDLE_ROWS), "reach")

    def side(pivot: str, member: str) -> DataFrame:
        columns = {"pivot": pivot, "member": member, "d": f"d{member}", "n": f"n_{member}", "outline": f"o_{member}"}
        return reach.select(*[F.col(old).alias(new) for old, new in columns.items()])

    ours, theirs = side("a", "x"), side("b", "y")
    near = (F.col("dx") + F.col("dy") + spread + 1e-9 >= F.col("gap")) & outlines_allow("n_x", "o_x", "n_y", "o_y", percent)
    # one side after the other: most members fall to the widest radius of the other unit
    half = wide.join(radius.select(F.col("pivot").alias("b"), F.col("radius").alias("rb")), "b", "left").join(ours, "a")
    half = half.filter(F.col("dx") + F.coalesce("rb", F.lit(0.0)) + spread + 1e-9 >= F.col("gap"))
    expanded = half.join(theirs, (half["b"] == theirs["b"]) & near & ((F.col("dx") > 0) | (F.col("dy") > 0)))
    pivots = (half["a"].alias("pivot_a"), half["b"].alias("pivot_b"))
    expanded = expanded.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *pivots).distinct()
    tried = written(verified(expanded, sets), "members-compared")
    found = tried.filter(_linked(percent)).select(F.col("pivot_a").alias("a"), F.col("pivot_b").alias("b"))
    if not found.isEmpty():
        labels = relabelled(labels, found, tried.count())
    # members of a star have the component of its pivot
    members = _labelled(inside.select("a", F.col("b").alias("node")), labels, "a", "component").select("node", "component")
    return written(members if labels is None else members.unionByName(labels), "jaccard-labels")


def jaccard_components(
    documents: DataFrame, percent: int = 80, words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Two documents link when 100 * common >= percent * union of their sets of distinct shingles. Fewer words than a shingle
    are one shingle; null and empty texts have an empty set and no links. Sets are compared, not ids: rows that repeat an
    id with different texts link by each of them, rows without an id too, and identical sets are one. The component is
    named by its smallest id, null if it has none. An empty table gives no rows.
    """
    all_rows = profiles(documents, percent, words, id_col, text_col)
    filled = all_rows.filter("n > 0")
    digest = ["n", "high", "low"]
    classes = filled.groupBy(*digest).agg(F.min("id").alias("first_id")).withColumn("class", F.monotonically_increasing_id())
    rows, shared = all_rows.agg(F.count(F.lit(1)), F.count("prefix")).first()
    classes = written(gathered(classes, rows), "set-classes")
    # identical sets have identical profiles: any row stands for its class
    usable = filled.filter(F.col("prefix").isNotNull()).join(classes.select(*digest, "class", "first_id"), digest)
    usable = usable.filter(F.col("id").eqNullSafe(F.col("first_id")))
    one = F.first(F.struct("n", "shared", "prefix", "outline", "held")).alias("one")
    sets = usable.groupBy(F.col("class").alias("id")).agg(one).select("id", "one.*")
    sets = written(gathered(sets, shared, HEAVY_ROWS), "sets")
    found = jaccard_labels(sets, percent).select(F.col("node").alias("class"), F.col("component").alias("of"))
    placed = classes.join(found, "class", "left").withColumn("of", F.coalesce("of", "class"))
    names = placed.groupBy("of").agg(F.min("first_id").alias("component"))
    mapped = placed.join(names, "of").select(*digest, "component")
    light = all_rows.select("id", *digest)
    return light.join(mapped, digest, "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )
