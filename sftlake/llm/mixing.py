"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are first added up by membership pattern (the set of sources they belong to). The flow network
is then small, whatever the corpus holds: a node per pattern, a node per source. A pattern offers its
words again and again at convex cost (the first use is free, each further one dearer), a source takes up to its quota. The cheapest full flow says how many words of each pattern go to
each source. Documents are chosen last: within a pattern they are put in the order of a seeded digest and each use
level is filled in that order. Where the cut falls is found from sums per digest prefix, so a
source with a third of all rows is never gathered in one task.

Targets: sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ...; they share all words by weight, a
target stops at ``max_repeat`` times its source's words, and the excess is shared again by weight.

Defined cases: a null text has 0 words and is never taken; a null source is a source of its own; a document in
no source (empty membership) is not taken; repeated rows are documents of their own, told apart by a
digest of id and text (equal rows share their fate); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.common import SPACES, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
PREFIX = 4


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space: words start where a space or the start precedes them."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    squeezed = F.btrim(F.regexp_replace(flat, " {2,}", " "))
    spaces = F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit("")))
    return F.when(F.length(squeezed) == 0, F.lit(0)).otherwise(spaces + F.lit(1)).cast("bigint")


def cyclic_weights(sources: Sequence[str | None], weights: Sequence[float] = WEIGHTS) -> dict[str | None, float]:
    """Weights by code point, null last. (UTF-8 byte order is code-point order.)"""
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    return {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}


def water_fill(sizes: dict, weights: dict, max_repeat: int = MAX_REPEAT) -> dict:
    """Targets that share all words by weight, none above ``max_repeat`` times its size.

    Sources that stop first (smallest limit per weight) are settled first; the rest share what is left.
    """
    order = sorted(sizes, key=lambda s: (max_repeat * sizes[s] / weights[s], s is None, s or ""))
    left, weight = float(sum(sizes.values())), float(sum(weights.values()))
    targets = {}
    for i, s in enumerate(order):
        limit = float(max_repeat * sizes[s])
        if left * weights[s] <= limit * weight:  # it stays below, and so do all after it
            level = left / weight
            targets |= {t: min(level * weights[t], float(max_repeat * sizes[t])) for t in order[i:]}
            break
        targets[s] = limit
        left, weight = left - limit, weight - weights[s]
    return targets


class Flow:
    """Maximum flow along shortest paths, a whole layer of them at a time. ``widen`` and another run continue from the flow that is there."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def add(self, a: int, b: int, room: int) -> int:
        for u, v, r in ((a, b, room), (b, a, 0)):
            self.arcs[u].append(len(self.to))
            self.to.append(v)
            self.room.append(r)
        return len(self.to) - 2

    def widen(self, arc: int, room: int) -> None:
        self.room[arc] += room

    def _layers(self, source: int) -> list[int]:
        layer = [-1] * len(self.arcs)
        layer[source], edge = 0, [source]
        while edge:
            further = []
            for u in edge:
                for e in self.arcs[u]:
                    if self.room[e] > 0 and layer[self.to[e]] < 0:
                        layer[self.to[e]] = layer[u] + 1
                        further.append(self.to[e])
            edge = further
        return layer

    def run(self, source: int, sink: int) -> int:
        total = 0
        while (layer := self._layers(source))[sink] >= 0:
            at, path = [0] * len(self.arcs), []
            while True:
                u = self.to[path[-1]] if path else source
                if u == sink:
                    step = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= step
                        self.room[e ^ 1] += step
                    total += step
                    path = path[: next(i for i, e in enumerate(path) if not self.room[e])]
                    continue
                own = self.arcs[u]
                while at[u] < len(own) and not (self.room[own[at[u]]] > 0 and layer[self.to[own[at[u]]]] == layer[u] + 1):
                    at[u] += 1
                if at[u] < len(own):
                    path.append(own[at[u]])
                elif path:  # a dead end: the arc that led here is done with
                    at[self.to[path.pop() ^ 1]] += 1
                else:
                    break
        return total


def route(patterns: dict[tuple, int], quotas: dict, max_repeat: int = MAX_REPEAT) -> dict[tuple, int]:
    """Words to take of each pattern (a tuple of sources) so that quotas are met as cheaply as possible.

    The k-th use of a pattern's words costs k * (k - 1) / 2, so flow repeats nothing while fresh words
    are left that can go to the same sources. Only the first arcs have a cost, so the cheapest flow is found level by level: all that first uses can
    carry, then, rerouting what is there, what second uses add, and so on.
    """
    names, keys = list(quotas), list(patterns)
    node = {s: 2 + len(keys) + i for i, s in enumerate(names)}
    flow = Flow(2 + len(keys) + len(names))
    offered = [flow.add(0, 2 + i, 0) for i in range(len(keys))]
    for i, p in enumerate(keys):
        for s in dict.fromkeys(p):
            flow.add(2 + i, node[s], max_repeat * patterns[p])
    for s in names:
        flow.add(node[s], 1, quotas[s])
    for _ in range(max_repeat):
        for arc, p in zip(offered, keys):
            flow.widen(arc, patterns[p])
        flow.run(0, 1)
    return {p: flow.room[arc ^ 1] for p, arc in zip(keys, offered)}


def _integer_quotas(targets: dict, total: int) -> dict:
    """Whole words: floors, and the largest remainders up to the total."""
    quotas = {s: int(t) for s, t in targets.items()}
    short = min(total, round(sum(targets.values()))) - sum(quotas.values())
    for s in sorted(targets, key=lambda s: (quotas[s] - targets[s], s is None, s or ""))[: max(0, short)]:
        quotas[s] += 1
    return quotas


def seeded_order(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys)))


def _rows(docs: DataFrame, doc_id: str, text: str, sources: Column | None, seed: int) -> list[Column]:
    member = F.array(F.col("source")) if sources is None else F.coalesce(sources, F.array().cast("array<string>"))
    return [
        F.col(doc_id).alias("_doc"), word_count(F.col(text)).alias("_size"),
        F.array_sort(F.array_distinct(member)).alias("_sources"),
        seeded_order(seed, F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_order"),
    ]


def mix_plan(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> dict:
    """Sizes, targets and quotas by source, and words by pattern, of rows (_sources, _size)."""
    # There are as many of these as kinds of membership, not of documents.
    sums = rows.groupBy("_sources").agg(F.sum("_size").alias("size")).collect()
    sizes: dict = {}
    for r in sums:
        for s in r._sources:
            sizes[s] = sizes.get(s, 0) + r.size
    total, listed = sum(r.size for r in sums if r._sources), sum(sizes.values())
    targets = water_fill(sizes, cyclic_weights(list(sizes), weights), max_repeat) if sizes else {}
    if listed != total:  # overlapping sources share the words that there are
        targets = {s: t * (total / listed) for s, t in targets.items()}
    quotas = _integer_quotas(targets, total)
    patterns = {tuple(r._sources): r.size for r in sums if r._sources and r.size}
    return {
        "sizes": sizes, "targets": targets, "quotas": quotas, "patterns": patterns,
        "words": route(patterns, quotas, max_repeat),
    }


def _bounds(rows: DataFrame, plan: dict) -> DataFrame:
    """A row per pattern: how often all its documents are used, and up to which digest once more."""
    table = [
        (list(p), plan["words"][p] // size, plan["words"][p] % size) for p, size in plan["patterns"].items()
    ]
    need = F.broadcast(rows.sparkSession.createDataFrame(table, "_p array<string>, _base bigint, _rest bigint"))
    prefix, same = F.substring("_order", 1, PREFIX), F.col("_sources") == F.col("_p")
    # Sums per digest prefix (65,536 at most per pattern) place the cut in one prefix of each pattern.
    before = F.sum("_sum").over(W.partitionBy("_sources").orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1))
    cut = (
        rows.groupBy("_sources", prefix.alias("_prefix")).agg(F.sum("_size").alias("_sum"))
        .withColumn("_before", F.coalesce(before, F.lit(0))).join(need, same)
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_sum")))
        .select("_p", "_base", "_rest", F.col("_prefix").alias("_cut"), "_before")
    )
    cut = F.broadcast(cut)  # a row per pattern
    # Inside that prefix: the documents up to the remaining words; the last one comes in if that is nearer.
    upto = F.sum("_size").over(W.partitionBy("_p").orderBy("_order").rangeBetween(W.unboundedPreceding, W.currentRow))
    over = F.col("_before") + F.col("_upto") - F.col("_rest")
    last = (
        rows.join(cut, same & (prefix == F.col("_cut"))).withColumn("_upto", upto)
        .where((over < F.col("_size")) & (F.abs(over) <= F.abs(over - F.col("_size"))))
        .groupBy(F.col("_p").alias("_of")).agg(F.max("_order").alias("_last"))
    )
    found = cut.join(last, F.col("_p") == F.col("_of"), "left").select("_p", "_base", "_rest", "_cut", "_last")
    # So small that it is brought here and sent out as one literal table.
    return F.broadcast(rows.sparkSession.createDataFrame(found.collect(), found.schema))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sources: Column | None = None, seed: int = 7,
    weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
) -> tuple[DataFrame, dict]:
    """Add ``_doc``, ``_size``, ``_sources`` and ``_taken`` (words the mix takes, repeats counted) to the documents, and
    return the plan too. Columns of these names are replaced; `mix_rows` keeps them."""
    mixed, plan = mix_rows(docs, doc_id, text, sources, seed, weights, max_repeat)
    kept = [c for c in docs.columns if c not in ("_doc", "_size", "_sources", "_taken")]
    return mixed.select(*(F.col("_row").getField(c).alias(c) for c in kept), "_doc", "_size", "_sources", "_taken"), plan


def mix_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sources: Column | None = None, seed: int = 7,
    weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
) -> tuple[DataFrame, dict]:
    """(_row, _doc, _size, _sources, _taken), ``_row`` being the document with all its columns, and the plan. ``sources`` is an
    array of the sources a document belongs to, by default its ``source``.

    Sizes and digests are computed once, beside the documents, into a table; the plan reads its narrow columns.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    wide = stored(docs.select(row, *_rows(docs, doc_id, text, sources, seed)), "mix-documents")
    plan = _planned(wide.drop("_row"), weights, max_repeat)
    return _taken(wide, plan["bounds"]), plan


def mix_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sources: Column | None = None, seed: int = 7,
    weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
) -> tuple[DataFrame, dict]:
    """(_doc, _size, _sources, _taken) of every document, and the plan: only narrow rows are written."""
    plan = _planned(stored(docs.select(*_rows(docs, doc_id, text, sources, seed)), "mix-rows"), weights, max_repeat)
    return mix_report(plan), plan


def _planned(narrow: DataFrame, weights: Sequence[float], max_repeat: int) -> dict:
    plan = mix_plan(narrow, weights, max_repeat)
    return plan | {"rows": narrow, "bounds": _bounds(narrow, plan)}


def _taken(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    joined = rows.join(bounds, F.col("_sources") == F.col("_p"), "left")
    again = (F.substring("_order", 1, PREFIX) < F.col("_cut")) | (F.col("_order") <= F.col("_last"))
    again = (F.col("_rest") > 0) & F.coalesce(again, F.lit(False))
    times = F.coalesce("_base", F.lit(0)) + F.coalesce(again, F.lit(False)).cast("bigint")
    return joined.withColumn("_taken", F.col("_size") * times).drop("_p", "_base", "_rest", "_cut", "_last", "_order")


def mix_report(plan: dict) -> DataFrame:
    """(_doc, _size, _sources, _taken) from the narrow table, without another look at the texts."""
    return _taken(plan["rows"], plan["bounds"])
