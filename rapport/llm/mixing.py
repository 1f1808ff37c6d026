"""Mixing sources to target weights by minimum-cost flow."""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rapport.llm.common import WORD
from rapport.sources.sinks import stored

SEED = 20
MAX_REPEATS = 3
# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
# Membership patterns the flow is solved for; they are aggregates, not documents.
MAX_PATTERNS = 100_000
CELLS = 4096
# Documents added one by one at most to fill what whole documents in order leave lacking.
FILLS = 8


class Flow:
    """Minimum-cost flow by successive shortest paths with node potentials."""

    def __init__(self):
        self.edges: list[list] = []  # to, room left, cost; the reverse edge has the next number
        self.out: dict = defaultdict(list)

    def edge(self, a, b, room: int, cost: int) -> int:
        self.out[a].append(len(self.edges))
        self.edges.append([b, room, cost])
        self.out[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def sent(self, edge: int) -> int:
        return self.edges[edge + 1][1]

    def solve(self, source, sink) -> None:
        height: dict = defaultdict(int)
        while True:
            far, back, queue, n = {source: 0}, {}, [(0, 0, source)], 0
            while queue:
                d, _, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    b, room, cost = self.edges[e]
                    step = d + cost + height[a] - height[b]
                    if room and (b not in far or step < far[b]):
                        far[b], back[b], n = step, e, n + 1
                        heapq.heappush(queue, (step, n, b))
            if sink not in far:
                return
            top = max(far.values())
            for node in list(self.out):
                height[node] += far.get(node, top)
            path, node = [], sink
            while node != source:
                path.append(back[node])
                node = self.edges[back[node] ^ 1][0]
            most = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= most
                self.edges[e ^ 1][1] += most


def route(patterns: dict[tuple, int], quotas: dict, repeats: int) -> dict[tuple, int]:
    """Words to take of every membership pattern so that the sources reach their quotas.

    ``patterns`` holds the words of the documents in exactly these sources. Their first use
    is free, each further one dearer, so repetition is spread evenly before it deepens.
    """
    flow, used = Flow(), defaultdict(list)
    for p, (members, size) in enumerate(patterns.items()):
        for r in range(repeats):
            used[members].append(flow.edge("words", ("p", p), size, r * r))
        for s in members:
            flow.edge(("p", p), ("s", s), repeats * size, 0)
    for s, quota in quotas.items():
        flow.edge(("s", s), "mix", quota, 0)
    flow.solve("words", "mix")
    return {members: sum(map(flow.sent, edges)) for members, edges in used.items()}


def targets(sizes: dict, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> dict:
    """Target of every source: its weight's share of all words, at most ``repeats`` its size.

    Sources go by code point, null last. What a source cannot take is shared again by weight
    until no source is above its limit.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        left, by = total - sum(full.values()), sum(weight[s] for s in open_)
        share = {s: left * weight[s] / by for s in open_}
        over = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not over:
            return {s: float(v) for s, v in {**full, **share}.items()}
        full |= {s: repeats * sizes[s] for s in over}


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, id: str = "doc_id", text: str = "text") -> Column:
    """Seeded place of a document in its pattern's order."""
    return F.xxhash64(F.lit(seed), id, text)


def choose(rows: DataFrame, quotas: dict | None = None, repeats: int = MAX_REPEATS):
    """How often each pattern's documents are taken: a list of (members, size, times, last, extras).

    ``rows`` has members (array of sources, sorted), size and draw. All documents of a
    pattern are taken ``times`` times, those up to ``last`` in the seeded order once more, and
    the few at ``extras`` too, which bring the words nearest to what the flow asks for.
    Running sums are taken over cells of the order first, then over the one cell of
    each pattern in which the wanted sum falls. ``quotas`` maps sources to words; without it,
    ``targets`` of single sources. Equal draws are taken together.
    """
    spark = rows.sparkSession
    sums = rows.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    sizes = {tuple(r.members): r["size"] for r in sums}
    if quotas is None:
        quotas = {s: int(t) for s, t in targets({m[0]: n for m, n in sizes.items()}, repeats=repeats).items()}
    taken = route(sizes, quotas, repeats)
    times = {m: min(taken[m] // n, repeats) if n else 0 for m, n in sizes.items()}
    want = [(list(m), taken[m] - times[m] * n) for m, n in sizes.items()]
    want = F.broadcast(spark.createDataFrame(want, "members array<string>, want long").where("want > 0"))

    part = F.shiftrightunsigned("draw", 64 - CELLS.bit_length() + 1).cast("int")
    cells = rows.groupBy("members", part.alias("cell")).agg(F.sum("size").alias("size"))
    so_far = Window.partitionBy("members").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("upto", F.sum("size").over(so_far)).join(want, "members")
    edge = cells.where("upto > want").groupBy("members", "want")
    edge = edge.agg(F.min(F.struct("cell", (F.col("upto") - F.col("size")).alias("before"))).alias("at"))
    edge = F.broadcast(edge.select("members", "want", "at.cell", "at.before"))
    # The order is that of the draw as an unsigned number, as cells are.
    place = F.col("draw").bitwiseXOR(F.lit(-(1 << 63)))
    inside = rows.withColumn("place", place).join(edge, "members").where(part == F.col("cell"))
    inside = inside.groupBy("members", "want", "before", "place").agg(F.sum("size").alias("size"))
    run = Window.partitionBy("members").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(run))
    fits = F.col("upto") <= F.col("want")
    ends = inside.groupBy("members", "want").agg(
        F.max(F.when(fits, F.col("place"))).alias("last"),
        F.coalesce(F.max(F.when(fits, F.col("upto"))), F.min("before")).alias("got"),
        F.min("place").alias("first"),
    )
    # Without a fitting row in the cell, the order ends just before the cell's first row.
    ends = ends.select("members", (F.col("want") - F.col("got")).alias("lack"), F.coalesce("last", F.col("first") - 1).alias("last"))
    found = {tuple(r.members): [r["last"], r["lack"], []] for r in ends.collect()}
    later = rows.where("size > 0").withColumn("place", place)
    for _ in range(FILLS):
        # What is lacking, and nothing where it is too little to matter.
        lacking = [(list(m), last, lack, given) for m, (last, lack, given) in found.items() if lack * 1000 > sizes[m]]
        if not lacking:
            break
        lacking = spark.createDataFrame(lacking, "members array<string>, last long, lack long, given array<long>")
        free = later.join(F.broadcast(lacking), "members")
        free = free.where((F.col("place") > F.col("last")) & ~F.array_contains("given", F.col("place")))
        # The largest document that fits; if none does, the one that comes nearest.
        off = F.abs(F.col("lack") - F.col("size"))
        best = F.struct(F.col("size") > F.col("lack"), off.alias("off"), "place", "size")
        picks = free.where(off < F.col("lack")).groupBy("members").agg(F.min(best).alias("best")).collect()
        if not picks:
            break
        for r in picks:
            held = found[tuple(r.members)]
            held[1] -= r.best["size"]
            held[2].append(r.best["place"])
    return [(list(m), n, times[m], found[m][0] if m in found else None, found[m][2] if m in found else []) for m, n in sizes.items()]


def copies(rows: DataFrame, plan: list) -> DataFrame:
    """Add members' ``source_size`` and ``copies``, how often the mix takes each row."""
    schema = "members array<string>, source_size long, times long, last long, extras array<long>"
    plan = F.broadcast(rows.sparkSession.createDataFrame(plan, schema))
    place = F.col("draw").bitwiseXOR(F.lit(-(1 << 63)))
    once = F.coalesce(place <= F.col("last"), F.lit(False)) | F.array_contains("extras", place)
    taken = F.when(F.col("size") > 0, F.col("times") + once.cast("long")).otherwise(F.lit(0))
    return rows.join(plan, "members").withColumn("copies", taken.cast("long")).drop("times", "last", "extras")


def _rows(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    source = F.array(F.col("source").cast("string"))
    return docs.select(*more, source.alias("members"), words().alias("size"), draw(seed).alias("draw"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """What the mix takes of every document: (doc_id, size, source_size, target, taken).

    ``size`` is the number of words; ``target`` that of the document's source by ``targets``.
    ``taken`` is a multiple of the size, three at most: documents are taken whole. A document
    without words, or with a null text, takes none. A null source is a source. Repeated rows
    are taken alike, a null id stays null, an empty table gives no rows. The same rows give
    the same mix. Columns other than doc_id, text and source are not read.
    """
    rows = stored(_rows(docs, seed, F.col("doc_id").cast("long").alias("doc_id")), "mix-rows")
    plan = choose(rows)
    goal = targets({m[0]: n for m, n, *_ in plan}) if plan else {}
    goal = rows.sparkSession.createDataFrame([([s], t) for s, t in goal.items()], "members array<string>, target double")
    out = copies(rows, plan).join(F.broadcast(goal), "members")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it is taken, columns as they are."""
    # Columns go by place, so any names do, also equal ones and such with dots.
    plain = [f"c{k}" for k in range(len(docs.columns))]
    read = [F.col(plain[docs.columns.index(c)]).alias(c) for c in ("doc_id", "text", "source")]
    packed = docs.toDF(*plain).select(F.struct(*plain).alias("row"), *read)
    rows = stored(_rows(packed, seed), "mix-rows")
    taken = copies(_rows(packed, seed, F.col("row")), choose(rows)).where("copies > 0")
    taken = taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("n"))
    return taken.select("row.*").toDF(*docs.columns)
