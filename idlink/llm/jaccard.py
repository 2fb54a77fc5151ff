"""Word n-gram Jaccard join by T-occurrence search, up to connected components.

Two texts link when their sets of distinct word n-grams have a Jaccard similarity of at least
`percent` hundredths. Texts with equal sets form one class before anything is searched. A class is named
by a 64-bit hash of its set; among n classes two meet by chance with probability n * n / 2^65.

Which classes can link at all is told by exact partitions of the sets. Similar sets differ in at most
H = (1 - t) / (1 + t) * (|x| + |y|) n-grams. If every set is dealt into H + H / 2 + 2 parts by hash, at least
H / 2 + 2 parts are equal in both; a set with fewer empty parts thus shares parts with content. Part
counts depend on a size class; a set is dealt for its own class and the next one, as partners differ in
size by 1 / t at most. The hash of a part, with its class and number, is a key; documents with equal keys
form a list. A set that shares fewer keys with any others than a partner would have to is left out. No link
is lost, and a passage that many documents share makes no list, as parts are drawn from the whole set.

Search: an inverted index over the n-grams of a bounded block of a list's members is searched for a query
(DivideSkip): the query's longest lists are set aside, the short ones are heap-merged, and members that
occur T - L times are probed in the long lists by binary search; those reaching the required overlap link.

Rounds: first one member is the query of its list, that which meets most others over all its lists;
members that are linked get one component. Lists within one component need no more. In the others, every
member outside the component of the first query is a query against members of other components, as far
as the prefixes of their sets, rarest n-grams first, leave room for the required overlap. Any two members
of a list are then in one component, or were compared, or cannot link, and a hot group of near copies,
linked or not, costs no comparison of all its pairs.
Rows are dealt by (query, block), at most about `block` members each, so no group meets in one task.

Defined results: null and empty texts, and texts without words, have empty sets and link with nothing.
Fewer words than n make one n-gram of the whole sequence. Repeated rows are one class. A null id counts
only where a component has no other. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm.common import NOT_BLANK, SlotFilter, Words, arrow_batches, grams, joined, kept, mix, out_schema, signed
from idlink.operators.skew import spread_join

#: Weight of a list's length against its skipping, from the published DivideSkip heuristic.
MU = 0.0085


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct n-gram hashes of one text's words."""
    if len(hashes) == 0:
        return np.empty(0, np.uint64)
    return np.unique(grams(hashes, min(n, len(hashes))))


def required_overlap(a: int, b: int, percent: int) -> int:
    """Least overlap of sets of these sizes at which they link."""
    return -(-percent * (a + b) // (100 + percent))


def _class_ends(percent: int, size: int) -> tuple[int, list[int]]:
    """The number of the size class of `size`, and the largest sizes of it and of the next class."""
    low, number = 1, 0
    while True:
        high = max(low, low * 100 // percent)
        if size <= high:
            return number, [high, (high + 1) * 100 // percent]
        low, number = high + 1, number + 1


def part_keys(items: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """For the set's size class and the next: hashes of the parts, and how many of them every partner shares."""
    number, ends = _class_ends(percent, len(items))
    out = []
    for k, end in enumerate(ends):
        differ = (100 - percent) * 2 * end // (100 + percent)
        if not differ:
            continue  # sets of this class link only when equal
        spare = differ // 2  # each part more is one more that linked sets share
        m = differ + 2 + spare
        seed = np.uint64((number + k) * 2 + 1)
        part = (mix(items ^ mix(np.full(1, seed))) % np.uint64(m)).astype(np.int64)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, part, mix(items + seed))
        full = np.bincount(part, minlength=m) > 0
        need = 2 + spare - int((~full).sum())
        if need < 1:  # a partner with fewer empty parts sends only its full ones
            full[:], need = True, 1
        names = (np.arange(m, dtype=np.uint64) << np.uint64(20)) + seed
        out.append((mix(sums ^ mix(names))[full], need))
    return out


def _sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    words = Words(batch.column("t"), NOT_BLANK)
    return [shingles(words.hash[a:b], n) for a, b in zip(words.first, words.first[1:])]


def _nodes(sets: list[np.ndarray]) -> np.ndarray:
    """One number for each set, the same for equal sets."""
    sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    return signed(mix(sums + np.array([len(s) for s in sets], np.uint64)))


def classes(docs: DataFrame, n: int, likely: SlotFilter | None = None) -> DataFrame:
    """Adds `n_shingles` and `node`, the number of the text's set. `docs` has the text in `t`.

    With `likely`, rows whose node cannot be among its keys are left out. That takes no step of its own before this
    one: two Python steps in a row take two workers of every core, and Spark keeps all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrow_batches(whole):
                sets = _sets(batch, n)
                nodes = _nodes(sets)
                out = batch.append_column("n_shingles", pa.array([len(s) for s in sets], pa.int64()))
                out = out.append_column("node", pa.array(nodes))
                yield out if likely is None else out.filter(pa.array(likely.maybe(nodes)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *out_schema("n_shingles long, node long").fields]))


def part_lists(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, node, lo): all lists with two different sets or more, each with the node that is asked for first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies met by one task are sent once
        for whole in batches:
            for batch in arrow_batches(whole):
                sets = _sets(batch, n)
                nodes = _nodes(sets)
                if len(seen) > 200_000:
                    seen.clear()
                new = [k for k, node in enumerate(nodes.tolist()) if len(sets[k]) and not (node in seen or seen.add(node))]
                found = [(nodes[k], c, *entry) for k in new for c, entry in enumerate(part_keys(sets[k], percent))]
                counts = [len(keys) for _, _, keys, _ in found]
                spread = lambda at, kind: pa.array(np.repeat(np.array([f[at] for f in found], kind), counts))  # noqa: B023, E731
                keys = signed(np.concatenate([*[f[2] for f in found], np.empty(0, np.uint64)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), spread(0, np.int64), spread(1, np.int8), spread(3, np.int32)], ["key", "node", "part_of", "need"]
                )

    keys = texts.select("t").mapInArrow(run, "key long, node long, part_of byte, need int")
    of = Window.partitionBy("key")
    lists = keys.withColumns({"lo": F.min("node").over(of), "hi": F.max("node").over(of)})
    lists = kept(lists.where(F.col("lo") < F.col("hi")).drop("lo", "hi").distinct(), "jaccard_members")
    # Who links shares `need` keys of one size class at least.
    likely = lists.groupBy("node", "part_of").agg(F.count("*").alias("have"), F.max("need").alias("least")).where("have >= least")
    lists = kept(lists.join(likely, ["node", "part_of"]).select("key", "node", "least"), "jaccard_likely")
    sizes = lists.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    lists = kept(lists.join(sizes, "key"), "jaccard_sized")
    # The member that meets most others over all its lists is the likeliest to link with them.
    weights = lists.groupBy("node").agg(F.sum("n").alias("weight"))
    lists = lists.drop("n").join(weights, "node")
    first = lists.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("lo"))
    return lists.drop("weight").join(first, "key")


def divide_skip(query: list[int], index: dict[int, list[int]], sizes: list[int], percent: int) -> list[int]:
    """Members of the index whose overlap with the query reaches what their sizes require.

    `index` has the ascending members of every n-gram; `sizes` the size of every member's set.
    """
    lists = sorted((found for item in query if (found := index.get(item))), key=len)
    least = -(-percent * len(query) // 100)  # no partner overlaps less
    if len(lists) < least:
        return []
    skipped = min(least - 1, int(least / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
    linked = []
    for member, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < least - skipped:
            continue
        need = required_overlap(len(query), sizes[member], percent)
        for k, found in enumerate(long):
            if count >= need or count + len(long) - k < need:
                break
            place = bisect_left(found, member)
            count += place < len(found) and found[place] == member
        if count >= need:
            linked.append(member)
    return linked


def _search_block(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """`query` and the members are ascending. The index has the n-grams of the query only: no others are asked for."""
    sizes = [len(m) for m in members]
    items = np.concatenate([*members, query[:0]])
    place = np.searchsorted(query, items).clip(max=len(query) - 1)
    hit = np.flatnonzero(query[place] == items)
    order = np.argsort(place[hit], kind="stable")  # members stay in ascending order
    owner = np.repeat(np.arange(len(members)), sizes)[hit][order]
    at, first = np.unique(place[hit][order], return_index=True)
    index = {item: found.tolist() for item, found in zip(query[at].tolist(), np.split(owner, first[1:]))}
    return divide_skip(query.tolist(), index, sizes, percent)


def search(pairs: DataFrame, texts: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """Links (query, member) among `pairs`. `texts` has node and t. Each pair is in one block of its query."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = pairs.groupBy("query").agg(F.count("*").alias("members"))
    pairs = pairs.join(counts, "query")
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("member"), F.ceil(F.col("members") / block).cast("long")))
    asked = pairs.select("query", "salt").distinct()
    rows = asked.join(texts, asked["query"] == texts["node"]).select("query", "salt", "node", "t")
    rows = rows.unionByName(pairs.join(texts, pairs["member"] == texts["node"]).select("query", "salt", "node", "t"))
    rows = rows.repartition(tasks, "query", "salt").sortWithinPartitions("query", "salt", F.col("node") != F.col("query"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple]:
            for whole in batches:
                for batch in arrow_batches(whole):
                    words = Words(batch.column("t"), NOT_BLANK)
                    keys = [batch.column(c).to_pylist() for c in ("query", "salt", "node")]
                    for k, key in enumerate(zip(*keys)):
                        yield *key, shingles(words.hash[words.first[k] : words.first[k + 1]], n)

        for (query, _), group in groupby(items(), itemgetter(0, 1)):
            asked, *members = [(node, found) for _, _, node, found in group]
            hits = _search_block(asked[1], [found for _, found in members], percent)
            if hits:
                yield pa.RecordBatch.from_pydict({"query": [query] * len(hits), "member": [members[k][0] for k in hits]})

    return kept(rows.mapInArrow(run, "query long, member long"), "jaccard_links")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); the component is its smallest node.

    Large-star and small-star steps, alternating until nothing changes, each from a stored table.
    """

    def both(df: DataFrame) -> DataFrame:
        return df.select("a", "b").union(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(df: DataFrame, large: bool) -> DataFrame:
        around = both(df) if large else df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = around.join(least, "a")
        out = joined.where(F.col("b") > F.col("a")) if large else joined
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(least.select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = kept(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    last = digest(edges)
    while True:
        edges = kept(star(kept(star(edges, True), "large_star"), False), "small_star")
        now = digest(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _with_component(df: DataFrame, of: DataFrame, column: str, name: str) -> DataFrame:
    of = of.select(F.col("node").alias(column), F.col("component").alias(name))
    return df.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def _texts_of(texts: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, t) of the given nodes; most other texts are left out before the shuffle."""
    rows = classes(texts, n, SlotFilter(nodes.select("node"))).join(nodes, "node")
    return kept(rows.groupBy("node").agg(F.first("t").alias("t")), "jaccard_texts")


def open_pairs(members: DataFrame, bodies: DataFrame, n: int, percent: int) -> DataFrame:
    """(query, member) of different components that may link and of which one is outside.

    `members` has node, c (its component) and out (outside the first component of some list). N-grams are
    ordered by the number of members that have them, rarest first. Two sets that link share one of their
    first |x| - t |x| + 1 n-grams, and from the first shared one on both have the required overlap left.
    N-grams of a single member come first of all: they are counted, but never joined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrow_batches(whole):
                sets = _sets(batch, n)
                counts = np.array([len(s) for s in sets], np.int64)
                columns = [
                    batch.column("node").take(pa.array(np.repeat(np.arange(len(sets)), counts))),
                    pa.array(np.repeat(counts, counts)),
                    pa.array(signed(np.concatenate([*sets, np.empty(0, np.uint64)]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "size", "g"])

    texts = bodies.join(members.select("node"), "node").select("node", "t")
    items = kept(texts.mapInArrow(run, "node long, size long, g long"), "jaccard_grams")
    shared = kept(items.groupBy("g").agg(F.count("*").alias("df")).where("df > 1"), "jaccard_shared")
    sets = items.join(shared, "g").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("found"))
    first = F.col("size") - F.ceil(F.lit(percent) * F.col("size") / 100) + 1
    sets = sets.withColumn("alone", F.col("size") - F.size("found"))
    sets = sets.withColumn("found", F.slice("found", F.lit(1), F.greatest(F.lit(0), first - F.col("alone")).cast("int")))
    rows = sets.join(members, "node").select("node", "size", "alone", "c", "out", F.posexplode("found").alias("place", "f"))
    left = (F.col("size") - F.col("alone") - F.col("place")).alias("left")
    rows = kept(rows.select("node", "size", "c", "out", left, F.col("f.g").alias("g")), "jaccard_prefixes")
    a, b = rows.alias("a"), rows.alias("b")
    enough = (100 + percent) * F.least("a.left", "b.left") >= percent * (F.col("a.size") + F.col("b.size"))
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("a.c") != F.col("b.c")) & (F.col("a.out") | F.col("b.out"))
    pairs = a.join(b, (F.col("a.g") == F.col("b.g")) & apart & enough)
    return pairs.select(F.col("a.node").alias("query"), F.col("b.node").alias("member")).distinct()


def set_components(texts: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """(node, component) of every set that links with a different one. `texts` has the text in `t`."""
    lists = kept(part_lists(texts, n, percent), "jaccard_lists")
    bodies = _texts_of(texts, kept(lists.select("node").distinct(), "jaccard_nodes"), n)

    # Who shares too few of a query's lists is left to the second round.
    asked = lists.where(F.col("node") != F.col("lo")).groupBy(F.col("lo").alias("query"), F.col("node").alias("member"))
    asked = asked.agg(F.count("*").alias("shared"), F.min("least").alias("least"))
    asked = kept(asked.where("shared >= least").select("query", "member"), "jaccard_pairs")
    links = search(asked, bodies, n, percent, block)
    found = kept(components(links.select(F.col("query").alias("a"), F.col("member").alias("b"))), "jaccard_found")

    # Lists that still hold several components: whoever is outside the first one is compared with the others.
    named = _with_component(_with_component(lists, found, "node", "c"), found, "lo", "c_lo")
    named = kept(named.withColumn("out", F.col("c") != F.col("c_lo")).select("key", "node", "c", "out"), "jaccard_named")
    still = named.join(named.where("out").select("key").distinct(), "key", "left_semi")
    members = kept(still.groupBy("node").agg(F.min("c").alias("c"), F.max("out").alias("out")), "jaccard_open")
    rest = open_pairs(members, bodies, n, percent)
    rest = kept(rest.join(asked, ["query", "member"], "left_anti"), "jaccard_pairs")
    more = search(rest, bodies, n, percent, block)
    edges = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(edges.union(more.select(F.col("query").alias("a"), F.col("member").alias("b"))))


def jaccard_components(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, block: int = 256
) -> DataFrame:
    """One row per document: id, n_shingles, node (its set), component and component_id.

    `component` is a number that the documents of a component share (null for an empty set),
    `component_id` the smallest id among them.
    """
    source = docs.select(F.col(id_).alias("id"), F.col(text).alias("t"))
    sets = kept(classes(source, n).drop("t"), "jaccard_sets")
    final = set_components(source.select("t"), n, percent, block)
    full = kept(_with_component(sets.where(F.col("n_shingles") > 0), final, "node", "component"), "jaccard_components")
    full = spread_join(full, full.groupBy("component").agg(F.min("id").alias("component_id")), ["component"], ["node", "id"])
    empty = sets.where(F.col("n_shingles") == 0).withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("id")})
    return full.unionByName(empty)


def keep_one(docs: DataFrame, id_: str = "doc_id", text: str = "text", n: int = 3, **options) -> DataFrame:
    """One document of each component, that with the smallest id, with the columns it came with.

    Rows with equal id and equal set are one document, of which one row stays. Only documents that
    may have to go are shuffled.
    """
    found = kept(jaccard_components(docs, id_, text, n=n, **options).select("id", "node", "component"), "jaccard_result")
    least = F.struct(F.col("id").isNull().alias("null"), "id", "node")
    stays = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(least).alias("stays"))
    goes = spread_join(found, stays, ["component"], ["node", "id"]).where(~(F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("node") == F.col("stays.node"))))
    twice = found.groupBy("id", "node").agg(F.count("*").alias("rows")).where(F.col("rows") > 1).drop("rows")
    odd = goes.select("id", "node", F.lit(True).alias("goes")).unionByName(twice.withColumn("goes", F.lit(False)))
    odd = kept(odd.groupBy("id", "node").agg(F.max("goes").alias("goes")), "jaccard_goes")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_).alias("id"), F.col(text).alias("t"))
    likely = SlotFilter(odd.select("node"))
    clear = likely.mark(rows, lambda b: _nodes(_sets(b, n)), "maybe").where(~F.col("maybe")).select("doc")
    check = joined(classes(rows, n, likely), odd, ["id", "node"], "left")
    single = check.where(F.col("goes").isNull()).select("doc")
    first = F.row_number().over(Window.partitionBy("id", "node").orderBy(F.xxhash64("t")))
    repeated = check.where(~F.col("goes")).withColumn("first", first).where("first = 1").select("doc")
    return clear.union(single).union(repeated).select("doc.*")


def jaccard_report(docs: DataFrame, id_: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, size of its set, smallest id of its component."""
    return jaccard_components(docs, id_, text, **options).select(F.col("id").alias(id_), "n_shingles", "component_id")
