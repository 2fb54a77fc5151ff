"""Language-model scores from a probabilistic suffix tree over words.

A text is its lower-cased words and one end symbol; before its first word stands an end symbol. The root
gives every symbol (c + 1) / (N + V + 1). A state is a context of one or two words. Every context of the
training texts is a candidate, and every symbol that follows it is listed. It stays when its next-symbol
distribution diverges from that of the next shorter context: N(c) times the Kullback-Leibler divergence must
exceed half the logarithm of N for each symbol that the state lists, and the shorter context must be a state too.
Smoothing: listed symbols are discounted by `discount`; the mass left goes to all other symbols in proportion
to the next shorter state, so every distribution sums to 1. A symbol is scored by the longest state that is a
suffix of its history.

Scale: all that scores a symbol after the words (a, b) is known where all positions after b meet: the pairs
and triples are counted there, states chosen and the positions scored. So positions are dealt into buckets by
b, some `size` of them each, and what a bucket finds is added up per text. A word b with more than `size`
positions is parted by a, and a pair (a, b) with more by text; their followers are counted over all texts
first and every part gets the counts. Words are numbers where they are frequent (at most 1 / `NUMBERED` of
them, sent to the tasks), else hashes. These are listed with their places and counts in portions by word, where
all counts of a word meet, and each bucket gets those of its positions. No word, pair or triple is left out.
Positions, hashes and counts travel packed by bucket or portion, as they take most of the disk.

`fit` with `Shares` makes a bounded tree instead, of contexts and symbols above a least share, which fits a
task; `score` scores with it. Words below the share are scored by a join with the full table of counts.

Words are 64-bit hashes; among n words two meet by chance with probability n * n / 2^65.

Defined results: a null text is empty, an end symbol only. Without training texts every count is 0 and
each symbol has probability 1. Repeated rows are scored each; repeated ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from idlink.llm.common import NOT_BLANK, Words, arrow_batches, kept, mix, row_ids, signed
from idlink.llm.langid import fold

END = np.int64(0)
_FLUSH = 4_000_000
#: Words of at least this share of all tokens have numbers that every task knows.
NUMBERED = 5e-7
#: Positions of the largest words and pairs that are not parted, those that a task gathers as a chunk before it deals them,
#: and those of a chunk that are looked up at once.
BUCKET = 1_000_000
_CHUNK = 4_000_000
_SLICE = 1_000_000


@dataclass(frozen=True)
class Shares:
    """Least shares of all tokens; each bounds a table of the model by its inverse."""

    word: float = 5e-7
    context: float = 1e-4
    symbol: float = 1e-6
    discount: float = 0.5


@dataclass
class Level:
    """States of one depth: ascending `states`, their log10 weight for unlisted symbols, and listed symbols."""

    states: np.ndarray
    rest: np.ndarray
    keys: np.ndarray  # state number * number of frequent words + symbol, ascending
    logs: np.ndarray


@dataclass
class Tree:
    total: int
    distinct: int
    words: np.ndarray  # ascending hashes of the frequent words
    counts: np.ndarray
    shares: Shares
    contexts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    levels: list[Level] = field(default_factory=list)

    @property
    def base(self) -> np.ndarray:
        return (self.counts + 1) / (self.total + self.distinct + 1)


def find(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the values in an ascending array, -1 where they are missing."""
    if not len(sorted_):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(sorted_, values).clip(max=len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts of a batch, each text closed by END, and the places of the ENDs."""
    words = Words(batch.column("t"), NOT_BLANK)
    ends = words.first[1:] + np.arange(batch.num_rows)
    out = np.insert(signed(words.hash), words.first[1:], END)
    return out, ends


def _shifted(x: np.ndarray, ends: np.ndarray, end_value: int, by: int) -> np.ndarray:
    """The value `by` places before, within each text; `end_value` directly before it, -1 farther away."""
    out = np.concatenate([np.full(by, -1, x.dtype), x])[: len(x)]
    starts = np.concatenate([[0], ends[:-1] + 1])
    for k in range(by):
        places = starts + k
        inside = places <= ends  # a text of one symbol has no second place
        out[places[inside]] = end_value if k == by - 1 else -1
    return out


def _summed(keys: Iterator[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """Distinct keys with counts; each flush adds up what a task has gathered."""
    waiting, size = [], 0

    def batch() -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], [name, "n"])

    for found in keys:
        waiting.append(found)
        size += len(found)
        if size > _FLUSH:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


def _states(tree: Tree, ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For every symbol and depth the state of its history, -1 for none."""
    end = int(find(tree.words, np.array([END]))[0])
    before = _shifted(ids, ends, end, 1)
    found = [find(tree.contexts, before)] if not tree.levels else [find(tree.levels[0].states, before)]
    if len(tree.levels) > 1:
        two = _shifted(ids, ends, end, 2)
        pairs = np.where((two >= 0) & (before >= 0), two * len(tree.words) + before, -1)
        found.append(find(tree.levels[1].states, pairs))
    return found


def _count(train: DataFrame, name: str, keys) -> DataFrame:
    """(name, n): how often `keys` of a batch occur in all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed((keys(b) for whole in batches for b in arrow_batches(whole)), name)

    return train.select("t").mapInArrow(run, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n"))


def _level(tree: Tree, states: np.ndarray, sizes: np.ndarray, keys: np.ndarray, n: np.ndarray, parent) -> Level:
    """Smoothed distributions of the states that pass the divergence test. `parent(state, symbol)` is what it diverges from."""
    h = len(tree.words)
    state, symbol = keys // h, keys % h
    shorter = parent(state, symbol)
    observed = n / sizes[state]
    given = (n - tree.shares.discount) / sizes[state]
    sums = lambda x: np.bincount(state, x, minlength=len(states))
    left, left_shorter = 1 - sums(observed), 1 - sums(shorter)
    rest = np.where(left > 0, left * np.log(np.maximum(left, 1e-12) / np.maximum(left_shorter, 1e-12)), 0)
    divergence = sums(observed * np.log(observed / shorter)) + rest
    listed = np.bincount(state, minlength=len(states))
    keep = (listed > 0) & (sizes * divergence > 0.5 * np.log(tree.total) * listed)
    number = np.cumsum(keep) - 1
    weight = (1 - sums(given)) / np.maximum(left_shorter, 1e-12)
    inside = keep[state]
    return Level(states[keep], np.log10(weight[keep]), number[state[inside]] * h + symbol[inside], np.log10(given[inside]))


def _look_up(level: Level, h: int, state: np.ndarray, symbol: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """log10 probabilities; `shorter` are those of the next shorter state, kept where there is no state."""
    at = find(level.keys, np.where((state >= 0) & (symbol >= 0), state * h + symbol, -1))
    logs = level.logs[at] if len(level.logs) else np.zeros(len(at))
    rest = level.rest[state] if len(level.rest) else np.zeros(len(state))
    return np.where(state < 0, shorter, np.where(at >= 0, logs, rest + shorter))


def fit(train: DataFrame, shares: Shares = Shares()) -> tuple[Tree, DataFrame]:
    """The tree and the table (h, n) of all words' counts; `train` has the text in `t`."""
    counts = kept(_count(train, "h", lambda batch: symbols(batch)[0]), "word_counts")
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = totals["n"] or 0, totals["v"]
    found = counts.where((F.col("n") >= shares.word * total) | (F.col("h") == int(END))).toPandas().sort_values("h")
    tree = Tree(total, distinct, found["h"].to_numpy(np.int64), found["n"].to_numpy(np.int64), shares)
    h = len(tree.words)
    if not h:
        return tree, counts
    tree.contexts = np.flatnonzero(tree.counts >= shares.context * total)
    send = train.sparkSession.sparkContext.broadcast

    def following(now: Tree, states: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys (state number * h + symbol) with their counts, of all symbols that follow a state often enough."""
        shared = send((now, states))

        def keys(batch: pa.RecordBatch) -> np.ndarray:
            known, candidates = shared.value
            words, ends = symbols(batch)
            ids = find(known.words, words)
            end = int(find(known.words, np.array([END]))[0])
            state = _shifted(ids, ends, end, 1)
            if depth == 2:
                two = _shifted(ids, ends, end, 2)
                state = np.where((two >= 0) & (state >= 0), two * len(known.words) + state, -1)
            state = find(candidates, state)
            both = (state >= 0) & (ids >= 0)
            return state[both] * len(known.words) + ids[both]

        df = kept(_count(train, "k", keys), f"contexts_{depth}").where(F.col("n") >= shares.symbol * total).toPandas().sort_values("k")
        return df["k"].to_numpy(np.int64), df["n"].to_numpy(np.int64)

    keys, n = following(tree, tree.contexts, 1)
    root = tree.base
    first = _level(tree, tree.contexts, tree.counts[tree.contexts], keys, n, lambda state, symbol: root[symbol])
    # Two-word contexts: frequent pairs whose second word is a state.
    often = (n >= shares.context * total) & np.isin(tree.contexts[keys // h], first.states)
    pairs = tree.contexts[keys[often] // h] * h + keys[often] % h
    often_in_states = np.isin(pairs % h, first.states)
    pairs, sizes = pairs[often_in_states], n[often][often_in_states]
    order = np.argsort(pairs)
    pairs, sizes = pairs[order], sizes[order]
    keys, n = following(tree, pairs, 2)

    def shorter(state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = find(first.states, pairs[state] % h)
        return 10 ** _look_up(first, h, at, symbol, np.log10(root[symbol]))

    tree.levels = [first, _level(tree, pairs, sizes, keys, n, shorter)]
    return tree, counts


def score(docs: DataFrame, tree: Tree, counts: DataFrame) -> DataFrame:
    """Adds n_tokens, n_known, train_tokens, base_score and score; `docs` has `id` and the text in `t`."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    rare = pa.struct([("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at = shared.value, 0
        h = len(known.words)
        unit = float(np.log10(known.total + known.distinct + 1))
        for whole in batches:
            for batch in arrow_batches(whole):
                words, ends = symbols(batch)
                ids = find(known.words, words)
                root = np.where(ids >= 0, np.log10(known.counts[ids] + 1.0) if h else 0.0, 0.0) - unit
                logs = root
                for level, state in zip(known.levels, _states(known, ids, ends)):
                    logs = _look_up(level, h, state, ids, logs)
                firsts = np.concatenate([[0], ends[:-1] + 1])
                per_text = lambda x: np.add.reduceat(x, firsts)  # noqa: B023, E731
                rare_at = np.flatnonzero(ids < 0)
                text = np.searchsorted(ends, rare_at)
                lists = []
                for a, b in zip(np.searchsorted(text, np.arange(batch.num_rows)), np.searchsorted(text, np.arange(1, batch.num_rows + 1))):
                    lists.append(np.unique(words[rare_at[a:b]], return_counts=True))
                offsets = np.concatenate([[0], np.cumsum([len(v) for v, _ in lists])]).astype(np.int32)
                values = [np.concatenate([x[k] for x in lists]).astype(np.int64) for k in (0, 1)]
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(rare)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(row_ids(at, batch.num_rows)),
                        pa.array(np.diff(ends, prepend=-1)),
                        pa.array(per_text((ids >= 0).astype(np.int64))),
                        pa.array(per_text(root)),
                        pa.array(per_text(logs)),
                        listed,
                    ],
                    ["id", "row", "n_tokens", "known", "base", "logs", "rare"],
                )
                at += batch.num_rows

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, row long, n_tokens long, known long, base double, logs double, rare array<struct<h:long,n:long>>"
    parts = kept(docs.select("id", "t").mapInArrow(run, schema), "scores")
    rest = parts.select("row", F.explode("rare").alias("r")).select("row", "r.h", F.col("r.n").alias("times"))
    rest = rest.join(counts, "h").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("plus")
    )
    df = parts.drop("rare").join(rest, "row", "left")
    more, plus = F.coalesce("more", F.lit(0)), F.coalesce("plus", F.lit(0.0))
    return df.select(
        "id",
        "n_tokens",
        (F.col("known") + more).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + plus).alias("base_score"),
        (F.col("logs") + plus).alias("score"),
    )


# ---- the whole tree, in buckets ----------------------------------------------------------


@dataclass
class Dealing:
    """Word numbers, and which bucket a position falls into."""

    total: int
    distinct: int
    words: np.ndarray  # ascending hashes of the numbered words
    numbers: np.ndarray  # their numbers, the most frequent first
    counts: np.ndarray  # by number
    buckets: int
    split: np.ndarray  # ascending hashes of the words with more positions than a bucket
    parts: np.ndarray  # their numbers of parts
    portions: tuple[int, int]  # of what follows a word: symbols without a number, and those with one
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # ascending hashes of such pairs

    def first(self, b: np.ndarray) -> np.ndarray:
        return (mix(b.view(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)

    def place(self, b: np.ndarray) -> np.ndarray:
        """The bucket of the positions after a word, or -1 less its place among the split words."""
        k = find(self.split, b)
        return np.where(k >= 0, -1 - k, self.first(b))

    def bucket(self, a: np.ndarray, b: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Buckets of positions after the words `a`, `b`."""
        at = self.first(b)
        k = find(self.split, b)
        parted = np.flatnonzero(k >= 0)
        if len(parted):
            a, b, rows = a[parted], b[parted], rows[parted]
            by_text = (b == END) | (find(self.pairs, pair_hash(a, b)) >= 0)
            dealt = mix(np.where(by_text, rows, a).view(np.uint64)) % self.parts[k[parted]].astype(np.uint64)
            at[parted] = (at[parted] + dealt.astype(np.int64)) % self.buckets
        return at


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return signed(mix(mix(a.view(np.uint64)) + b.view(np.uint64)))


def _histories(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all symbols of a batch: the two words before (END twice for a text's first), the symbol, its text."""
    words, ends = symbols(batch)
    before = np.concatenate([[END], words[:-1]])
    two = np.where(before == END, END, np.concatenate([[END, END], words])[: len(words)])
    return two, before, words, np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))


def _train(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("train").to_numpy(zero_copy_only=False).astype(bool)


def _rows_summed(found: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Distinct rows of several columns, the last one added up; each flush adds up what a task has gathered."""
    waiting, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*waiting)]
        table = pa.table(columns, names).group_by(names[:-1], use_threads=False).aggregate([(names[-1], "sum")])
        table = table.select([*names[:-1], f"{names[-1]}_sum"]).rename_columns(names)
        return table.combine_chunks().to_batches()[0]

    for columns in found:
        waiting.append(columns)
        size += len(columns[0])
        if size > _FLUSH // 4:
            yield batch()
            waiting, size = [], 0
    if size:
        yield batch()


def _counted(docs: DataFrame, names: list[str], found, name: str) -> DataFrame:
    """Rows that `found` gives for the batches, equal ones added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows_summed((found(b) for whole in batches for b in arrow_batches(whole)), names)

    schema = ", ".join(f"{c} long" for c in names)
    return kept(docs.mapInArrow(run, schema).groupBy(*names[:-1]).agg(F.sum(names[-1]).alias(names[-1])), name)


def _pack(x: np.ndarray, kind: str = "<u4") -> bytes:
    """Values with their first bytes together, then their second ones and so on."""
    bytes_ = np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return zstandard.compress(np.ascontiguousarray(bytes_.T).tobytes(), 1)


def _unpack(column: pa.ChunkedArray, kind: str = "<u4") -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    raw = (np.frombuffer(zstandard.decompress(x), np.uint8) for x in column.to_pylist())
    found = [np.ascontiguousarray(x.reshape(size, -1).T).view(kind).reshape(-1) for x in raw]
    return [x.astype(np.int64) for x in found] if kind == "<u4" else found


def _pack_ascending(x: np.ndarray) -> bytes:
    return _pack(np.diff(x.view(np.uint64), prepend=np.uint64(0)), "<u8")


def _unpack_ascending(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.cumsum(x, dtype=np.uint64).view(np.int64) for x in _unpack(column, "<u8")]


def _runs(x: np.ndarray) -> zip:
    """Begin and end of every run of equal values."""
    edges = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]])) if len(x) else np.empty(0, np.int64)
    return zip(edges.tolist(), edges[1:].tolist())


def _row(names: list[str], kinds: list[pa.DataType], values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


#: Followers of a place: symbols, their counts after a split word, and those in all training texts if without a number.
_NOTES = "place long, a binary, s binary, n binary, c binary"


def _noted(batches: Iterator[pa.RecordBatch], plan: Dealing) -> Iterator[pa.RecordBatch]:
    """The symbols without a number after all words, and all symbols after split words: places, hashes and
    how often in training texts, packed by portion."""

    def found() -> Iterator[tuple[np.ndarray, ...]]:
        for whole in batches:
            for batch in arrow_batches(whole):
                _, b, s, text = _histories(batch)
                train = _train(batch)[text]
                needed = (find(plan.words, s) < 0) | (train & (find(plan.split, b) >= 0))
                yield plan.place(b[needed]), s[needed], train[needed].astype(np.int64)

    rare, numbered = (np.uint64(x) for x in plan.portions)
    for summed in _rows_summed(found(), ["place", "s", "n"]):
        place, s, n = (summed.column(k).to_numpy() for k in range(3))
        pairs = plan.portions[0] + (mix(mix(s.view(np.uint64)) + place.view(np.uint64)) % numbered).astype(np.int64)
        portion = np.where(find(plan.words, s) < 0, (mix(s.view(np.uint64)) % rare).astype(np.int64), pairs)
        order = np.lexsort((s, portion))
        place, s, n, portion = place[order] + len(plan.split), s[order], n[order], portion[order]
        for x, y in _runs(portion):
            row = [int(portion[x]), _pack(place[x:y]), _pack_ascending(s[x:y]), _pack(n[x:y])]
            yield _row(["portion", "place", "s", "n"], [pa.int64(), *[pa.binary()] * 3], row)


def _merged(parts: pa.Table, plan: Dealing, size: int, schema: pa.Schema) -> pa.Table:
    """A portion by place, packed. A symbol without a number has all its places in one portion, and so its count."""
    place, s, n = (np.concatenate(x) for x in (_unpack(parts.column("place")), _unpack_ascending(parts.column("s")), _unpack(parts.column("n"))))
    order = np.lexsort((s, place))
    place, s = place[order] - len(plan.split), s[order]
    firsts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (place[1:] != place[:-1])]))
    place, s, n = place[firsts], s[firsts], np.add.reduceat(n[order], firsts)
    symbols, at = np.unique(s, return_inverse=True)
    c = np.where(find(plan.words, symbols) < 0, np.bincount(at, n).astype(np.int64), 0)[at]
    n[place >= 0] = 0  # counted in the bucket itself
    rows = []
    for x, y in _runs(place):
        hot = s[x:y][(n[x:y] > size) & (s[x:y] != END)]
        rows.append((int(place[x]), None, _pack_ascending(s[x:y]), _pack(n[x:y], "<i8"), _pack(c[x:y], "<i8"), hot))
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _deep_notes(batches: Iterator[pa.RecordBatch], plan: Dealing) -> Iterator[pa.RecordBatch]:
    """Followers of pairs (a, b) with their counts, packed by place of b."""
    waiting, size = [], 0

    def packed() -> Iterator[pa.RecordBatch]:
        a, b, s, n = (x.to_numpy() for x in pa.Table.from_batches(waiting).select(["a", "b", "s", "n"]).columns)
        place = plan.place(b)
        order = np.lexsort((s, place))
        a, s, n, place = a[order], s[order], n[order], place[order]
        for x, y in _runs(place):
            row = [int(place[x]), _pack(a[x:y], "<i8"), _pack_ascending(s[x:y]), _pack(n[x:y], "<i8"), _pack(0 * n[x:y], "<i8")]
            yield _row(["place", "a", "s", "n", "c"], [pa.int64(), *[pa.binary()] * 4], row)

    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size > _FLUSH // 4:
            yield from packed()
            waiting, size = [], 0
    if size:
        yield from packed()


def _with_histories(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the two words before, and of the symbols at the places `at`. What begins a text has an END before it, as
    each text is closed by one; the first text has the last place before it, which is an END as well."""
    before = at - 1
    return np.where(words[before] == END, before, at - 2), before, at


def _dealt(batches: Iterator[pa.RecordBatch], plan: Dealing, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The positions of a task's texts, chunk by chunk, packed by bucket: numbers of a, b and the symbol (words
    without a number follow as hashes), and of the text. The few words b of a bucket are listed, the most frequent
    first, and b is a place in that list. A chunk's first row has its ids and what is known of them."""
    waiting, size, at = [], 0, 0
    h = len(plan.words)
    unit = np.log10(plan.total + plan.distinct + 1)

    def packed() -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays([w[0] for w in waiting])
        train, lengths, words = (np.concatenate([w[k] for w in waiting]) for k in (1, 2, 3))
        waiting.clear()
        text = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        start = int(row_ids(at, 1)[0])
        codes, bucket = np.empty(len(words), np.int32), np.empty(len(words), np.int32)
        sums = np.zeros((2, len(ids)))
        for x in range(0, len(words), _SLICE):
            here = np.arange(x, min(x + _SLICE, len(words)))
            a, b, s = (words[k] for k in _with_histories(words, here))
            bucket[here] = plan.bucket(a, b, start + text[here].astype(np.int64))
            found = find(plan.words, s)
            known = found >= 0
            codes[here] = np.where(known, plan.numbers[found] if h else 0, -1)
            logs = np.log10(plan.counts[codes[here]] * known + 1.0) if h else np.zeros(len(s))
            first, last = text[here[0]], text[here[-1]] + 1
            sums[:, first:last] += [np.bincount(text[here] - first, w, last - first) for w in (known, logs - unit)]
        head = [ids, *[pa.array(x.astype(k)) for x, k in zip((lengths, *sums), (np.int64, np.int64, float))]]
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        for x, y in _runs(bucket):
            triple = _with_histories(words, order[x:y])
            numbers = [codes[k].astype(np.int64) for k in triple]
            hashes = np.unique(np.concatenate([words[k[n < 0]] for k, n in zip(triple, numbers)]))
            for k, n in zip(triple, numbers):
                n[n < 0] = h + np.searchsorted(hashes, words[k[n < 0]])
            listed, at_listed, times = np.unique(numbers[1], return_inverse=True, return_counts=True)
            by_times = np.argsort(-times, kind="stable")
            numbers[1] = np.argsort(by_times)[at_listed]
            texts = text[order[x:y]].astype(np.int64)
            packs = [_pack(c) for c in (*numbers, 2 * np.diff(texts, prepend=0) + train[texts], listed[by_times])]
            packs.append(_pack_ascending(hashes))
            lists = [pa.ListArray.from_arrays(pa.array([0, 0 if x else len(ids)], pa.int32()), v) for v in head]
            row = [pa.array([int(bucket[x])]), *[pa.array([c], pa.binary()) for c in packs], pa.array([start]), *lists]
            yield pa.RecordBatch.from_arrays(row, schema.names)

    for whole in batches:
        for batch in arrow_batches(whole):
            words, ends = symbols(batch)
            waiting.append((batch.column("id"), _train(batch), np.diff(ends, prepend=-1), words))
            size += len(words)
            if size > _CHUNK:
                texts = sum(len(w[0]) for w in waiting)
                yield from packed()
                at, size = at + texts, 0
    if waiting:
        yield from packed()


def _scored(packed: pa.Table, notes: pa.Table, plan: Dealing, shares: Shares) -> list[list[bytes]]:
    """Texts with the sums of their scores in one bucket, and texts with the counts of their words without numbers:
    packed, for every row. The bucket has all contexts that end in its words, or notes of them."""
    h, unit = len(plan.words), plan.total + plan.distinct + 1
    none = np.empty(0, np.int64)
    followers = _unpack_ascending(notes.column("s"))
    each = [len(x) for x in followers]
    given = {"s": np.concatenate([none, *followers])}
    given |= {c: np.concatenate([none, *_unpack(notes.column(c), "<i8")]) for c in "nc"}
    place = notes.column("place").to_numpy()
    given["b"] = np.zeros(len(place), np.int64)
    given["b"][place < 0] = plan.split[-1 - place[place < 0]]
    given["b"] = np.repeat(given["b"], each)
    deep = np.repeat(notes.column("a").is_valid().to_numpy(), each)
    given["a"] = np.zeros(len(deep), np.int64)
    given["a"][deep] = np.concatenate([none, *_unpack(notes.column("a").drop_null(), "<i8")])
    del followers
    lists = _unpack_ascending(packed.column("hashes"))
    known = [given[c] for c in "abs"]
    noted = np.unique(np.concatenate(known))
    rare = np.unique(np.concatenate([*lists, noted[find(plan.words, noted) < 0]]))
    words = h + len(rare)

    def number(x: np.ndarray) -> np.ndarray:
        at = find(plan.words, x)
        return np.where(at >= 0, plan.numbers[at] if h else 0, h + np.searchsorted(rare, x))

    def codes(c: str) -> list[np.ndarray]:
        found = _unpack(packed.column(c))
        return [listed[x] for x, listed in zip(found, _unpack(packed.column("listed")))] if c == "b" else found

    a, b, s = (
        np.concatenate([np.where(x < h, x, h + np.searchsorted(rare, w)[np.maximum(x - h, 0)] if len(w) else 0) for x, w in zip(codes(c), lists)])
        for c in "abs"
    )
    marked = _unpack(packed.column("text"))
    train = np.concatenate([x & 1 for x in marked]).astype(bool)
    texts = [np.cumsum(x >> 1) for x in marked]
    na, nb, ns = (number(x) for x in known)
    counts = np.concatenate([plan.counts, np.zeros(len(rare), np.int64)])
    counted = ~deep & (ns >= h)
    counts[ns[counted]] = given["c"][counted]
    end = int(number(np.array([END]))[0]) if h else -1
    root = (counts + 1) / unit
    tree = Tree(plan.total, plan.distinct, np.empty(words, np.int64), counts, shares)

    def level(contexts: np.ndarray, symbol: np.ndarray, n: np.ndarray, parent) -> Level:
        """Of followers listed with counts; `contexts` are numbers that `parent` understands."""
        states, at = np.unique(contexts, return_inverse=True)
        keys = at * words + symbol
        order = np.argsort(keys)
        sizes = np.bincount(at, n, minlength=len(states))
        return _level(tree, states, sizes, keys[order], n[order], lambda state, symbol: parent(states[state], symbol))

    # Followers of words: counted here, or noted for words whose positions lie in other buckets too.
    noted_words = np.unique(nb[~deep & (given["n"] > 0)])
    split = np.zeros(words, bool)
    split[noted_words] = True
    here = train & ~split[b]
    keys, n = np.unique(b[here] * words + s[here], return_counts=True)
    from_notes = ~deep & (given["n"] > 0)
    first = level(
        np.concatenate([keys // words, nb[from_notes]]),
        np.concatenate([keys % words, ns[from_notes]]),
        np.concatenate([n, given["n"][from_notes]]),
        lambda context, symbol: root[symbol],
    )

    def shorter(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return _look_up(first, words, find(first.states, context), symbol, np.log10(root[symbol]))

    # Positions in order of their pairs, so that all that follows looks up neighbours.
    pair = np.where(b == end, -1, a * words + b)
    order = np.argsort(pair, kind="stable")
    b, s, train, pair = b[order], s[order], train[order], pair[order]
    del a
    noted_pairs, noted_at = np.unique(na[deep] * words + nb[deep], return_inverse=True)
    here = train & (pair >= 0) & (find(noted_pairs, pair) < 0) & (find(first.states, b) >= 0)
    pairs, at = np.unique(pair[here], return_inverse=True)
    keys, n = np.unique(at * words + s[here], return_counts=True)
    inside = find(first.states, noted_pairs % words)[noted_at] >= 0
    second = level(
        np.concatenate([pairs[keys // words], noted_pairs[noted_at][inside]]),
        np.concatenate([keys % words, ns[deep][inside]]),
        np.concatenate([n, given["n"][deep][inside]]),
        lambda context, symbol: 10 ** shorter(context % words, symbol),
    )
    logs, times = np.empty(len(s)), np.empty(len(s), np.int64)
    logs[order] = _look_up(second, words, np.where(pair >= 0, find(second.states, pair), -1), s, shorter(b, s))
    times[order] = np.where(s >= h, counts[s], -1)
    out, at = [], 0
    for text in texts:
        edges = np.flatnonzero(np.diff(text, prepend=-1))
        score, n = np.add.reduceat(logs[at : at + len(text)], edges), times[at : at + len(text)]
        out.append([_pack(np.diff(text[edges], prepend=0)), _pack(score, "<f8"), _pack(text[n >= 0]), _pack(n[n >= 0], "<i8")])
        at += len(text)
    return out


def _added(parts: pa.Table) -> dict[str, np.ndarray | pa.Array]:
    """What all buckets found of the texts of one chunk."""
    head = {c: parts.column(c).combine_chunks().flatten() for c in ("id", "n_tokens", "n_known", "base_score")}
    texts = np.concatenate([np.cumsum(x) for x in _unpack(parts.column("text"))])
    score = np.concatenate(_unpack(parts.column("score"), "<f8"))
    rare, n = np.concatenate(_unpack(parts.column("rare"))), np.concatenate(_unpack(parts.column("times"), "<i8"))
    sums = lambda at, x: np.bincount(at, x, minlength=len(head["id"]))
    head["n_known"] = head["n_known"].to_numpy() + sums(rare, n > 0).astype(np.int64)
    head["base_score"] = head["base_score"].to_numpy() + sums(rare, np.log10(n + 1.0))
    return head | {"score": sums(texts, score)}


def whole_scores(docs: DataFrame, shares: Shares = Shares(), size: int = BUCKET) -> DataFrame:
    """Scores by the tree of all contexts; `docs` has `id`, the text in `t`, and whether to learn from it in `train`."""
    spark = docs.sparkSession
    every = kept(_count(docs.where("train"), "h", lambda batch: symbols(batch)[0]), "word_counts")
    sums = every.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    found = every.where((F.col("n") >= NUMBERED * total) | (F.col("h") == int(END))).toPandas().sort_values("h")
    words, n = found["h"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    numbers = np.empty(len(n), np.int64)
    numbers[np.argsort(-n, kind="stable")] = np.arange(len(n))
    often = every.where(F.col("n") > size).toPandas().sort_values("h")
    buckets = 1 + 3 * total // (2 * size)
    parts = np.minimum(1 + often["n"].to_numpy(np.int64) // size, buckets)
    # Portions of about half a bucket, by the positions that can go there.
    portions = tuple(1 + 2 * int(x) // size for x in (total - n.sum(), often["n"].sum()))
    plan = Dealing(total, distinct, words, numbers, np.sort(n)[::-1].copy(), buckets, often["h"].to_numpy(np.int64), parts, portions)
    send = spark.sparkContext.broadcast
    shared = send(plan)
    noted_schema = to_arrow_schema(StructType.fromDDL(f"{_NOTES}, hot array<long>"))

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _noted(batches, shared.value)

    def merge(parts: pa.Table) -> pa.Table:
        return _merged(parts, shared.value, size, noted_schema)

    noted = docs.select("t", "train").mapInArrow(note, "portion long, place binary, s binary, n binary")
    noted = kept(noted.groupBy("portion").applyInArrow(merge, f"{_NOTES}, hot array<long>"), "followers_1")
    places = [(-1 - i, int((f + j) % buckets)) for i, (f, k) in enumerate(zip(plan.first(plan.split), parts)) for j in range(k)]
    places = F.broadcast(spark.createDataFrame(places, "place long, bucket long"))
    columns = ["bucket", "place", "a", "s", "n", "c"]
    notes = noted.where("place >= 0").withColumn("bucket", F.col("place")).select(columns)
    notes = notes.unionByName(noted.where("place < 0").join(places, "place").select(columns))
    hot = noted.where(F.size("hot") > 0).select("place", F.explode("hot").alias("s")).toPandas()
    if len(hot):
        plan.pairs = np.sort(pair_hash(plan.split[-1 - hot["place"].to_numpy(np.int64)], hot["s"].to_numpy(np.int64)))
        shared = send(plan)

        def triples(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            a, b, s, text = _histories(batch)
            inside = (find(shared.value.pairs, pair_hash(a, b)) >= 0) & (b != END) & _train(batch)[text]
            return a[inside], b[inside], s[inside], np.ones(int(inside.sum()), np.int64)

        def note_deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _deep_notes(batches, shared.value)

        deep = _counted(docs, ["a", "b", "s", "n"], triples, "followers_2").mapInArrow(note_deep, _NOTES)
        notes = notes.unionByName(deep.join(places, "place").select(columns))

    kind = docs.schema["id"].dataType
    head = StructType([StructField("id", ArrayType(kind))])
    head = StructType([*head, *StructType.fromDDL("n_tokens array<long>, n_known array<long>, base_score array<double>")])
    packing = StructType([*StructType.fromDDL("bucket long, a binary, b binary, s binary, text binary, listed binary, hashes binary, start long"), *head])
    parts_of = StructType([*StructType.fromDDL("start long, text binary, score binary, rare binary, times binary"), *head])
    result = StructType([StructField("id", kind), *StructType.fromDDL("n_tokens long, n_known long, base_score double, score double")])
    names, part_names, result_names = (to_arrow_schema(x) for x in (packing, parts_of, result))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt(batches, shared.value, names)

    def run(packed: pa.Table, notes: pa.Table) -> pa.Table:
        if not packed.num_rows:  # a part that has no position
            return part_names.empty_table()
        found = [pa.array(x, pa.binary()) for x in zip(*_scored(packed, notes, shared.value, shares))]
        pa.default_memory_pool().release_unused()  # the worker stays
        return pa.table([packed.column("start"), *found, *[packed.column(c) for c in head.names]], part_names.names)

    def add(parts: pa.Table) -> pa.Table:
        return pa.table(_added(parts)).select(result_names.names)

    bucketed = docs.select("id", "t", "train").mapInArrow(deal, packing).groupBy("bucket")
    sums = bucketed.cogroup(notes.groupBy("bucket")).applyInArrow(run, parts_of).groupBy("start").applyInArrow(add, result)
    return sums.select("id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def score_report(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2, shares: Shares | None = None, size: int = BUCKET
) -> DataFrame:
    """Learns from all folds but one and scores every document: by the whole tree, or with `shares` by a bounded one."""
    source = docs.select(F.col(id_).alias("id"), F.col(text).alias("t"), (fold(F.col(id_), folds) != held_out).alias("train"))
    if shares is None:
        df = whole_scores(source, size=size)
    else:
        tree, counts = fit(source.where("train"), shares)
        df = score(source, tree, counts)
    return df.select(F.col("id").alias(id_), (fold(F.col("id"), folds) == held_out).alias("held_out"), *df.columns[1:])
