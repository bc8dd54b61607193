"""Filling fixed-capacity containers with items, by the linear grouping scheme.

Only the histogram of sizes (at most `capacity` entries, whatever the corpus)
is planned in one place: large sizes are sorted into groups of equal cardinality
and rounded up to their group's largest, configurations of the few rounded sizes
are optimised by column generation, actual sizes are substituted for the rounded
ones, and small sizes go best-fit into what is left. Every large item goes into
a configuration: what the linear program leaves in fractions of containers is
rounded up, the largest fraction first. The plan is a list of runs of equal
containers, so it does not grow with the corpus either. Documents find their
container by their rank within their size, which is counted in salted parts.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.encode import FOLDER, count_tokens
from cadenza.session import written
from cadenza.sources.tables import table

#: Sizes above this part of the capacity are large: they are grouped and configured. Of several plans the one with the
#: fewest containers is taken; the next is made only if the one before needs more than the volume does.
LARGE = (0.3, 0.2)
#: Groups of large sizes.
GROUPS = 96
#: Up to so many large sizes each is a group of its own, so that none is rounded.
EXACT = 256
#: Rows of container_sizes that are taken in one run; more are refused.
MOST_SPECS = 10_000
#: Steps of room that configurations are planned in at most; rounded sizes are rounded up to them.
STEPS = 16_384


def linear_groups(sizes: np.ndarray, counts: np.ndarray, k: int) -> list[np.ndarray]:
    """Indices of descending sizes in at most k groups of about equal cardinality; one size stays in one group. Few sizes are a group each."""
    if len(sizes) <= EXACT:
        return [np.array([i]) for i in range(len(sizes))]
    upto = np.cumsum(counts)
    of = np.minimum((upto - counts) * k // max(1, upto[-1]), k - 1)
    return [np.flatnonzero(of == g) for g in np.unique(of)]


def _best_pattern(w: np.ndarray, y: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the largest dual value: an unbounded knapsack over the rounded sizes.

    Filled in blocks as wide as the least size, since nothing in a block depends on the same block.
    """
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    width = int(w.min())
    for low in range(width, capacity + 1, width):
        room = np.arange(low, min(low + width, capacity + 1))
        before = room[:, None] - w[None, :]
        gain = np.where(before >= 0, best[np.maximum(before, 0)] + y, -1.0)
        j = gain.argmax(axis=1)
        top = np.maximum.accumulate(np.r_[best[low - 1], gain[np.arange(len(room)), j]])
        best[room] = top[1:]
        took[room] = np.where(top[1:] > top[:-1] + 1e-12, j, -1)
    pattern, c = np.zeros(len(w), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= int(w[took[c]])
    return float(best[capacity]), pattern


def configurations(w: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """(configuration, number of containers) that hold all of demand, from the linear program over all configurations.

    Whole containers first; then a container for each fraction, the largest
    first, holding those of its items that are still without one.
    """
    k = len(w)
    basis = np.diag(np.maximum(1, capacity // w)).astype(float)
    inverse = np.diag(1 / np.diag(basis))
    x = demand / np.diag(basis)
    for n in range(rounds):
        if n % 100 == 99:  # what the updates lose
            inverse = np.linalg.inv(basis)
        y = inverse.sum(axis=0)
        value, pattern = _best_pattern(w, np.maximum(y, 0), capacity)
        if value <= 1 + gap:
            break
        d = inverse @ pattern
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(np.argmin(ratio))
        step = ratio[out]
        x = np.maximum(x - step * d, 0)
        x[out] = step
        basis[:, out] = pattern
        row = inverse[out] / d[out]
        inverse -= np.outer(d, row)
        inverse[out] = row
    whole = np.floor(x + 1e-9)
    out = [(basis[:, i].astype(np.int64), int(whole[i])) for i in range(k) if whole[i]]
    rest = np.maximum(np.round(demand - basis @ whole), 0)
    for i in sorted(range(k), key=lambda i: whole[i] - x[i]):
        some = np.minimum(basis[:, i], rest)
        if x[i] > whole[i] + 1e-6 and some.any():
            out.append((some.astype(np.int64), 1))
            rest -= some
    while rest.any():  # what numerical error leaves
        some, room = np.zeros(k, np.int64), capacity
        for j in range(k):
            n = int(min(rest[j], room // w[j]))
            some[j], room = n, room - n * int(w[j])
        out.append((some, 1))
        rest -= some
    return out


class Plan:
    """Runs of equal containers and the ranks of each size that go into them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.n = 0
        self.configured = 0  # containers opened by configurations
        self.used: dict[int, int] = defaultdict(int)  # ranks of each size given away
        self.rows: list[tuple[int, int, int, int, int]] = []  # size, from rank, to rank, first container, copies in each
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first container, how many)
        self.rooms: list[int] = []  # the rooms of open, in order

    def put(self, size: int, first: int, many: int, copies: int) -> None:
        lo = self.used[size]
        self.used[size] = lo + many * copies
        self.rows.append((size, lo, lo + many * copies, first, copies))

    def leave(self, room: int, first: int, many: int) -> None:
        """Containers that have this room left."""
        if room and not self.open[room]:
            bisect.insort(self.rooms, room)
        self.open[room].append((first, many))

    def new(self, many: int, content: list[tuple[int, int]]) -> None:
        """many new containers with copies of each size."""
        for size, copies in content:
            self.put(size, self.n, many, copies)
        self.leave(self.capacity - sum(s * c for s, c in content), self.n, many)
        self.n += many

    def best_fit(self, size: int, count: int) -> None:
        """count items of one size, each into the container with the least room that takes it, or a new one."""
        while count:
            at = bisect.bisect_left(self.rooms, size)
            if at == len(self.rooms):
                copies = min(self.capacity // size, count)
                self.new(many := count // copies, [(size, copies)])
                count -= many * copies
                continue
            room = self.rooms[at]
            first, many = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(at)
            copies = min(room // size, count)
            take = min(many, count // copies)
            if take < many:
                self.leave(room, first + take, many - take)
            self.put(size, first, take, copies)
            self.leave(room - copies * size, first, take)
            count -= take * copies


def plan(sizes: dict[int, int], capacity: int, groups: int = GROUPS, larges: tuple[float, ...] = LARGE) -> Plan:
    """sizes: size -> count, all from 1 to capacity. The plan of the fewest containers of those for each part that counts as large."""
    best = None
    for large in larges:
        one = _plan(sizes, capacity, groups, large)
        if best is None or one.n < best.n:
            best = one
        if best.n == -(-sum(s * n for s, n in sizes.items()) // capacity):
            break
    return best


def _plan(sizes: dict[int, int], capacity: int, groups: int, large: float) -> Plan:
    out, left = Plan(capacity), dict(sizes)
    if full := left.pop(capacity, 0):  # fills a container alone: no group of its own size's weight
        out.new(full, [(capacity, 1)])
    big = np.array(sorted((s for s in left if s > large * capacity), reverse=True), np.int64)
    if len(big):
        counts = np.array([sizes[int(s)] for s in big], np.int64)
        members = linear_groups(big, counts, groups)
        w = np.array([big[m].max() for m in members])
        demand = np.array([counts[m].sum() for m in members], float)
        queues = [[[int(big[i]), int(counts[i])] for i in m] for m in members]
        # fullest configurations first, so that what rounding leaves over is small
        unit = -(-capacity // STEPS)
        for pattern, many in sorted(configurations(-(-w // unit), demand, capacity // unit), key=lambda p: -int(p[0] @ w)):
            slots = [(int(j), int(pattern[j])) for j in np.flatnonzero(pattern)]
            while many:
                content: dict[int, int] = defaultdict(int)
                times = min([many, *(queues[j][0][1] // a for j, a in slots if queues[j])]) if all(queues[j] for j, _ in slots) else 0
                if times:
                    for j, a in slots:
                        content[queues[j][0][0]] += a
                        _take(queues[j], a * times, left)
                else:  # a container with sizes of two runs
                    times = 1
                    for j, a in slots:
                        for _ in range(a):
                            if queues[j]:
                                content[queues[j][0][0]] += 1
                                _take(queues[j], 1, left)
                if not content:
                    break
                out.new(times, sorted(content.items(), reverse=True))
                many -= times
    out.configured = out.n
    for size in sorted(left, reverse=True):
        out.best_fit(size, left[size])
    return out


def _take(queue: list[list[int]], n: int, left: dict[int, int]) -> None:
    queue[0][1] -= n
    left[queue[0][0]] -= n
    if not queue[0][1]:
        queue.pop(0)


def token_counts(spark: SparkSession, documents: DataFrame, tokenizers: list[str], folder: str = FOLDER) -> DataFrame:
    """(tokenizer, doc_id, n_tokens), all from one reading of the texts, written once: it is read several times and costly to make."""
    return written(count_tokens(documents, "doc_id", "text", tokenizers, folder), "token_counts")


def pack(counts: DataFrame, specs: list[tuple[str, int]], part_rows: int = 1_000_000) -> DataFrame:
    """(tokenizer, capacity, container_id, doc_id, piece, n_tokens): counts (tokenizer, doc_id, n_tokens) in containers of each spec.

    A document of more than capacity tokens is divided into full pieces and a
    rest, piece 0 first; all others stay whole. Documents without tokens are
    spread over the containers (container 0 if there is no other). Repeated rows
    are items of their own. part_rows: items that one task ranks at once.
    Empty counts or specs give an empty result.
    """
    spark = counts.sparkSession
    wanted = spark.createDataFrame(specs, "tokenizer string, capacity int")
    items = counts.join(F.broadcast(wanted), "tokenizer")  # the table of capacities: fixed and small
    full = F.floor(F.col("n_tokens") / F.col("capacity")).cast("int")
    last = F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")) - 1, F.lit(0)).cast("int")
    items = items.select("tokenizer", "capacity", "doc_id", "n_tokens", full.alias("full"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    size = F.when(F.col("piece") < F.col("full"), F.col("capacity")).otherwise(F.col("n_tokens") % F.col("capacity"))
    items = items.select("tokenizer", "capacity", "doc_id", "piece", size.cast("int").alias("size"))
    # at most capacity + 1 sizes a spec come to the driver
    hist: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for r in items.groupBy("tokenizer", "capacity", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        hist[r.tokenizer, r.capacity][r["size"]] = r.n
    rows, totals = [], []
    for (name, capacity), sizes in hist.items():
        p = plan({s: n for s, n in sizes.items() if s}, capacity)
        rows += [(name, capacity, *r) for r in p.rows]
        totals.append((name, capacity, max(1, p.n)))
    runs = spark.createDataFrame(rows, "tokenizer string, capacity int, size int, lo bigint, hi bigint, first bigint, copies bigint")
    bins = spark.createDataFrame(totals, "tokenizer string, capacity int, n_containers bigint")
    parts = max(1, -(-sum(n for s in hist.values() for n in s.values()) // part_rows))
    key = ["tokenizer", "capacity", "size"]
    # the rank within a size, counted in parts: a size of a third of all documents is no task's own
    items = items.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    ahead = items.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = ahead.withColumn("before", F.sum("n").over(W.partitionBy(*key).orderBy("part")) - F.col("n")).drop("n")
    local = items.withColumn("k", F.row_number().over(W.partitionBy(*key, "part").orderBy("doc_id", "piece")))
    ranked = local.join(ahead, [*key, "part"]).withColumn("rank", F.col("before") + F.col("k") - 1)
    fits = [ranked[c] == runs[c] for c in key] + [ranked["rank"] >= runs["lo"], ranked["rank"] < runs["hi"]]
    some = ranked.where("size > 0").join(F.broadcast(runs), fits)  # bounded by the capacities, not by the documents
    some = some.select(*[ranked[c] for c in ("tokenizer", "capacity", "doc_id", "piece", "size")], (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("copies"))).cast("bigint").alias("container_id"))
    none = ranked.where("size = 0").join(F.broadcast(bins), ["tokenizer", "capacity"]).withColumn("container_id", F.col("rank") % F.col("n_containers"))
    cols = ["tokenizer", "capacity", "container_id", "doc_id", "piece", F.col("size").alias("n_tokens")]
    return some.select(*cols).unionByName(none.select(*cols))


def specs_of(container_sizes: DataFrame) -> list[tuple[str, int]]:
    """The distinct usable rows; a row without a tokenizer or with a capacity under 1 has no containers. More than MOST_SPECS are a ValueError."""
    rows = container_sizes.where("tokenizer IS NOT NULL AND capacity >= 1").select("tokenizer", F.col("capacity").cast("int")).distinct().limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} sizes of containers")
    return sorted((r[0], r[1]) for r in rows)


def containers(spark: SparkSession, sf_dir: str, folder: str = FOLDER) -> DataFrame:
    """Every document in containers, for each row of container_sizes."""
    specs = specs_of(table(spark, sf_dir, "container_sizes"))
    if not specs:
        return pack(spark.createDataFrame([], "tokenizer string, doc_id bigint, n_tokens int"), specs)
    counts = token_counts(spark, table(spark, sf_dir, "documents"), sorted({s[0] for s in specs}), folder)
    return pack(counts, specs)


def fill(packed: DataFrame) -> DataFrame:
    """Per tokenizer and capacity: containers, the fewest possible by volume, the fullest container and the part of room used."""
    per = packed.groupBy("tokenizer", "capacity", "container_id").agg(F.sum("n_tokens").alias("held"))
    out = per.groupBy("tokenizer", "capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("held").alias("tokens"), F.max("held").alias("most"))
    least = F.ceil(F.col("tokens") / F.col("capacity"))
    return out.select("tokenizer", "capacity", "n_containers", least.alias("least"), "most", F.round(F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("used"))
