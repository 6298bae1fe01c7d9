"""SimHash near-duplicates: fingerprints linked within a Hamming radius, found with vantage-point trees.

A vantage-point tree over a bounded sample splits the space into shards. Every distinct fingerprint
lives in one shard; by the triangle bound it also visits, as a query, each shard that its ball of the
radius overlaps (only shards before its own, so each pair meets once). Inside a shard a second tree is
split over residents and queries together, and leaves compare all that is left, so links are exact.
A shard hands on a spanning set of links, not the pairs, and ``components`` joins them up.

Where documents also have a size, links can be confined to sizes within a ratio; size is then one more
distance that the trees may split by.

Cases: null, empty and word-less texts have fingerprint 0 and link like any other; repeated rows and copies
share one fingerprint and so a component; null ids take part but are no component id unless the
whole component has none; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import batch_of, cut, folded, longs, mapped, pick, sliced, with_rows
from ringwatch.llm.components import components

#: Residents of a shard, of a leaf, and the sample the top tree is fitted on.
SHARD_POINTS = 4096
LEAF_POINTS = 256
SAMPLE_POINTS = 16_384
SEED = 42


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, joined by one space; of all words if there are fewer."""
    own = folded(text)
    if not own:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(own), xxhash.xxh64_intdigest
    if len(own) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())], np.uint64)


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Further 64 bits of each hash: lane 0 is the hash itself, others mix it with the lane's number."""
    if not lane:
        return hashes
    x = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def fingerprint(hashes: np.ndarray, bits: int = 64) -> bytes:
    """Big-endian lanes; a bit is 1 where more than half the hashes have it."""
    lanes = []
    for lane in range(bits // 64):
        ones = np.zeros(64, np.int64)
        mixed = _lane(hashes, lane).astype(">u8")
        for at in range(0, len(mixed), 1 << 16):
            part = mixed[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
        lanes.append(np.packbits(2 * ones > len(hashes)).tobytes())
    return b"".join(lanes)


def fingerprints(docs: DataFrame, width: int = 3, bits: int = 64, key: str = "doc_id") -> DataFrame:
    """``key``, fp (bits / 8 bytes), size (number of shingles) of each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hashes = [shingle_hashes(t, width) for t in batch.column("text").to_pylist()]
            yield batch_of(
                doc_id=batch.column("doc_id"), fp=pa.array([fingerprint(h, bits) for h in hashes], pa.binary()),
                size=longs([len(h) for h in hashes]))

    return mapped(pick(docs, key, "text").withColumnRenamed(key, "doc_id"), work, "doc_id long, fp binary, size long")


def _lanes(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(len(column), -1)


def _distance(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ one).sum(1, dtype=np.int32)


class Reach:
    """How far links go: bits, and the logarithm of the size ratio (None: any)."""

    def __init__(self, radius: int, ratio: float | None):
        self.radius, self.log_ratio = radius, None if ratio is None else -math.log(ratio)

    def split(self, points: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> tuple | None:
        """The vantage point or size that halves the points with the fewest on both sides; None if none does."""
        best, found = len(points), None
        for v in points[rng.choice(len(points), min(6, len(points)), replace=False)]:
            d = _distance(points, v)
            mu = int(np.partition(d, (len(d) - 1) // 2)[(len(d) - 1) // 2])
            inside = int((d <= mu).sum())
            both = int((np.abs(2 * d - 2 * mu - 1) <= 2 * self.radius).sum())
            if inside < len(points) and both + abs(2 * inside - len(points)) // 4 < best:
                best, found = both + abs(2 * inside - len(points)) // 4, (v, mu)
        if self.log_ratio is not None:
            t = float(np.partition(sizes, (len(sizes) - 1) // 2)[(len(sizes) - 1) // 2])
            inside = int((sizes <= t).sum())
            both = int((np.abs(sizes - t) <= self.log_ratio).sum())
            if inside < len(points) and both + abs(2 * inside - len(points)) // 4 < best:
                found = (None, t)
        return found

    def sides(self, rule: tuple, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a point lives inside, and whether its ball meets the inside and the outside."""
        v, mu = rule
        x, reach = (sizes, self.log_ratio) if v is None else (_distance(points, v), self.radius)
        return x <= mu, x <= mu + reach, x + reach > mu


def top_tree(points: np.ndarray, sizes: np.ndarray, n_shards: int, reach: Reach) -> list:
    """Nested [rule, inside, outside]; leaves are shard numbers."""
    rng, numbers = np.random.default_rng(SEED), iter(range(1 << 30))

    def build(rows: np.ndarray, shards: int) -> object:
        rule = reach.split(points[rows], sizes[rows], rng) if shards > 1 and len(rows) > 1 else None
        if rule is None:
            return next(numbers)
        inside, _, _ = reach.sides(rule, points[rows], sizes[rows])
        half = shards // 2
        return [rule, build(rows[inside], shards - half), build(rows[~inside], half)]

    return [build(np.arange(len(points)), n_shards), next(numbers)]


def _route(tree: list, points: np.ndarray, sizes: np.ndarray, reach: Reach) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, home) of every visit: home shards, and earlier shards that a ball meets."""
    rows, shards, homes = [], [], []

    def go(node: object, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, int):
            rows.append(at)
            shards.append(np.full(len(at), node))
            homes.append(home)
            return
        lives, meets_in, meets_out = reach.sides(node[0], points[at], sizes[at])
        go(node[1], at[meets_in], (home & lives)[meets_in])
        go(node[2], at[meets_out], (home & ~lives)[meets_out])

    go(tree[0], np.arange(len(points)), np.ones(len(points), bool))
    row, shard, home = np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)
    own = np.zeros(len(points), np.int64)
    own[row[home]] = shard[home]
    keep = home | (shard < own[row])
    return row[keep], shard[keep], home[keep]


def _roots(label: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        above = label[x]
        if np.array_equal(above, x):
            return x
        x = above


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of each pair; every root is the smallest row of its set."""
    while len(a):
        a, b = _roots(label, a), _roots(label, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))


class Shard:
    """Residents of one shard, their sets, and what their queries link to."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, reach: Reach):
        self.points, self.sizes, self.reach = points, sizes, reach
        self.label = np.arange(len(points))
        self._meet(points, sizes, None)

    def ask(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For queries with any link: the query and one resident it links to."""
        first = np.full(len(points), -1)
        self._meet(points, sizes, first)
        hit = np.nonzero(first >= 0)[0]
        return hit, first[hit]

    def _meet(self, points: np.ndarray, sizes: np.ndarray, first: np.ndarray | None) -> None:
        rng = np.random.default_rng(SEED)
        stack = [(np.arange(len(self.points)), np.arange(len(points)), 0)]
        while stack:
            mine, asked, depth = stack.pop()
            if not len(mine) or not len(asked):
                continue
            rule = None
            if len(mine) > LEAF_POINTS and depth < 40:
                rule = self.reach.split(self.points[mine], self.sizes[mine], rng)
            if rule is None:
                self._compare(mine, asked, points, sizes, first)
                continue
            inside, _, _ = self.reach.sides(rule, self.points[mine], self.sizes[mine])
            _, meets_in, meets_out = self.reach.sides(rule, points[asked], sizes[asked])
            stack += [(mine[inside], asked[meets_in], depth + 1), (mine[~inside], asked[meets_out], depth + 1)]

    def _compare(self, mine: np.ndarray, asked: np.ndarray, points: np.ndarray, sizes: np.ndarray, first: np.ndarray | None) -> None:
        step = max(1, (1 << 19) // len(mine))
        held = self.points[mine]
        for at in range(0, len(asked), step):
            q = asked[at:at + step]
            # The first half of the lanes leaves few pairs for the rest.
            far = np.bitwise_count(points[q, :1] ^ held[:, 0][None, :])
            for lane in range(1, (held.shape[1] + 1) // 2):
                far += np.bitwise_count(points[q, lane][:, None] ^ held[:, lane][None, :])
            a, b = np.nonzero(far <= self.reach.radius)
            a, b = q[a], mine[b]
            if held.shape[1] > 1:
                near = np.bitwise_count(points[a] ^ self.points[b]).sum(1, dtype=np.int32) <= self.reach.radius
                a, b = a[near], b[near]
            if not len(a):
                continue
            if self.reach.log_ratio is not None:
                near = np.abs(sizes[a] - self.sizes[b]) <= self.reach.log_ratio + 1e-12
                a, b = a[near], b[near]
            if first is None:
                _unite(self.label, a, b)
                continue
            head = np.nonzero(first[a] < 0)[0]
            first[a[head[::-1]]] = b[head[::-1]]
            _unite(self.label, first[a], b)


def links(points: DataFrame, radius: int, ratio: float | None = None) -> DataFrame:
    """(a, b): fingerprints whose links connect the same sets as all pairs within the radius. ``points`` (fp, size)
    is a written table of distinct fingerprints."""
    reach, n = Reach(radius, ratio), points.count()
    n_shards = max(1, math.ceil(n / SHARD_POINTS))
    share = min(1.0, 2.0 * SAMPLE_POINTS / max(n, 1))
    sample = points.filter(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).limit(SAMPLE_POINTS).toArrow()
    fitted = np.zeros((0, 1), np.uint64) if not len(sample) else _lanes(sample.column("fp"))
    tree = top_tree(fitted, np.log(np.maximum(sample.column("size").to_numpy(), 1)), n_shards, reach)[:1]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, shard, home = _route(
                tree, _lanes(batch.column("fp")), np.log(np.maximum(batch.column("size").to_numpy(), 1)), reach)
            at = pa.array(row)
            yield batch_of(
                shard=longs(shard), role=longs(~home), fp=batch.column("fp").take(at), size=batch.column("size").take(at))

    visits = mapped(points.select("fp", "size"), visit, "shard long, role long, fp binary, size long")
    visits = visits.repartition(n_shards, "shard").sortWithinPartitions("shard", "role", "fp")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, shard = None, [], None

        def ready() -> Shard:
            return shard or Shard(*(np.concatenate(x) for x in list(zip(*held))[:2]), reach)

        def names() -> pa.Array:
            return pa.concat_arrays([h[2] for h in held])

        def closing(done: Shard) -> pa.RecordBatch:
            root = _roots(done.label, np.arange(len(done.label)))
            tied = np.nonzero(root != np.arange(len(root)))[0]
            own = names()
            return batch_of(a=own.take(pa.array(tied)), b=own.take(pa.array(root[tied])))

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = batch.column("shard").to_numpy() * 2 + batch.column("role").to_numpy()
            edges = [0, *(np.nonzero(np.diff(marks))[0] + 1).tolist(), len(marks)]
            for x, y in zip(edges, edges[1:]):
                own = batch.slice(x, y - x)
                if marks[x] // 2 != number:
                    if held:
                        yield closing(ready())
                    number, held, shard = marks[x] // 2, [], None
                fp = own.column("fp")
                points_, sizes = _lanes(fp), np.log(np.maximum(own.column("size").to_numpy(), 1))
                if marks[x] % 2 == 0:
                    held.append((points_, sizes, fp))
                elif held:
                    shard = ready()
                    hit, resident = shard.ask(points_, sizes)
                    if len(hit):
                        yield batch_of(a=fp.take(pa.array(hit)), b=names().take(pa.array(resident)))
        if held:
            yield closing(ready())

    return mapped(visits, meet, "a binary, b binary")


def near_duplicates(
        docs: DataFrame, width: int = 3, radius: int = 3, bits: int = 64, ratio: float | None = None,
        key: str = "doc_id") -> DataFrame:
    """doc_id (from ``key``), fp, size, component_id: the smallest id that links lead to, its own included."""
    if bits not in (64, 128, 256):
        raise ValueError("fingerprints have 64, 128 or 256 bits")
    rows = cut(fingerprints(docs, width, bits, key))
    classes = cut(rows.groupBy("fp").agg(F.min("size").alias("size"), F.min("doc_id").alias("least")))
    tied = components(links(classes, radius, ratio))
    named = classes.join(tied, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "size", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, radius: int = 44, bits: int = 256, ratio: float = 0.8) -> DataFrame:
    """The documents with one of each component: the one of the smallest id. Fingerprints alone decide here;
    ``near.one_of_each`` verifies every link by the exact similarity.

    With the default of 256 bits, two sets of shingles of similarity J differ in about 256 / pi * acos(2 J / (1 + J))
    bits: 39 for 0.8, with a deviation of 6, and 128 with a deviation of 8 for unrelated texts.
    """
    numbered = with_rows(docs)
    found = near_duplicates(numbered, width, radius, bits, ratio, "__row").select(
        F.col("doc_id").alias("__row"), F.col("component_id").alias("__component"))
    ids = pick(numbered, "__row", "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__row"))
    kept = ids.join(found, "__row").groupBy("__component").agg(first.alias("f")).select(F.col("f.__row").alias("__row"))
    return numbered.join(kept, "__row", "left_semi").drop("__row")
