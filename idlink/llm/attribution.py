"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' character spans are joined with the spans of its
sections by interval, and a token that crosses a boundary is allotted by an explicit rule:

- `start`: to the section of its first character;
- `most`: to the section with most of its characters, the earlier one in a tie;
- `split`: to every section it touches, by its share of characters (counts are then fractions).

Sections do not overlap and come in order; characters in none of them belong to the section `rest`.
Tokens within one character (parts of its bytes) have the span of that character.

Defined results: null and empty texts have the section `rest` with no tokens, as every document has. A
section without characters has no tokens. Repeated rows are counted each. Very long texts are encoded
whole; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idlink.llm import tokens
from idlink.llm.common import out_schema, portions

RULES = ("start", "most", "split")
Section = tuple[str, int, int]


def allot(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and which tokens touch more than one; sections fill the text in order."""
    n = len(starts)
    if not n or not len(spans):
        return np.zeros(n), np.zeros(len(spans), bool)
    first = np.searchsorted(ends, spans[:, 0], "right").clip(max=n - 1)
    last = np.maximum(first, np.searchsorted(ends, spans[:, 1] - 1, "right").clip(max=n - 1))
    crossing = first != last
    if rule == "start":
        return np.bincount(first, minlength=n).astype(float), crossing
    counts = np.bincount(first[~crossing], minlength=n).astype(float)
    # Most crossing tokens touch two neighbours.
    two = np.flatnonzero(last == first + 1)
    i, (a, b) = first[two], spans[two].T
    share = (ends[i] - a) / (b - a)
    if rule == "most":
        share = (2 * (ends[i] - a) >= b - a).astype(float)
    counts += np.bincount(i, share, n) + np.bincount(i + 1, 1 - share, n)
    for t in np.flatnonzero(last > first + 1).tolist():
        i, j, (a, b) = first[t], last[t], spans[t]
        overlap = np.minimum(ends[i : j + 1], b) - np.maximum(starts[i : j + 1], a)
        if rule == "most":
            counts[i + int(np.argmax(overlap))] += 1
        else:
            counts[i : j + 1] += overlap / (b - a)
    return counts, crossing


def filled(sections: list[Section], length: int) -> list[Section]:
    """The sections with `rest` in every gap between them."""
    out, at = [], 0
    for name, start, end in sections:
        if start > at:
            out.append(("rest", at, start))
        if end > start:
            out.append((name, start, end))
        at = max(at, end)
    if length > at:
        out.append(("rest", at, length))
    return out


_LINE = re.compile(r"[^\n]+")


def head_and_body(text: str) -> list[Section]:
    """The first line with a character is the head, all after its line feed the body."""
    line = _LINE.search(text)
    if not line:
        return []
    return [("head", line.start(), line.end()), ("body", min(line.end() + 1, len(text)), len(text))]


_SENTENCE_END = re.compile(r"[.!?]\s+")


def sentences(text: str) -> list[Section]:
    """Sentences by number. One ends after the blanks that follow its full stop, so the next one's first token crosses."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [(str(k), start, end) for k, (start, end) in enumerate(zip([0, *ends], ends), 1)]


def attribute(
    docs: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    sections: Callable[[str], list[Section]] = sentences,
    rule: str = "most",
    tokenizer: str = tokens.DEFAULT,
) -> DataFrame:
    """One row per document and section: id, section, n_chars, n_tokens (a double), doc_tokens, crossing (tokens of
    the document that touch several sections)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    source = docs.select(F.col(id_).alias("id"), F.col(text).alias("t"))

    def rows_of(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        """Sections and tokens of all texts meet in one interval join, on places in the joined texts."""
        spans, n_tokens = tokens.id_encoder(tokenizer).spans(texts)
        parts = [filled(sections(t), len(t)) for t in texts]
        n_parts = np.array([len(p) for p in parts], np.int64)
        base = np.cumsum([0, *map(len, texts)])
        bounds = np.array([x[1:] for p in parts for x in p], np.int64).reshape(-1, 2) + np.repeat(base[:-1], n_parts)[:, None]
        counts, crossing = allot(spans, bounds[:, 0], bounds[:, 1], rule)
        crossed = np.bincount(np.repeat(np.arange(len(texts)), n_tokens)[crossing], minlength=len(texts))
        chars = bounds[:, 1] - bounds[:, 0]
        at, names, sizes, found = [], [], [], []
        place = 0
        for k, own in enumerate(parts):
            entries: dict[str, list] = {"rest": [0, 0.0]}
            for (name, _, _), size, n in zip(own, chars[place : place + len(own)].tolist(), counts[place : place + len(own)].tolist()):
                entry = entries.setdefault(name, [0, 0.0])
                entry[0] += size
                entry[1] += n
            place += len(own)
            at += [k] * len(entries)
            names += entries
            sizes += [e[0] for e in entries.values()]
            found += [e[1] for e in entries.values()]
        at = np.array(at, np.int64)
        columns = [ids.take(pa.array(at)), pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(found, pa.float64())]
        columns += [pa.array(n_tokens[at]), pa.array(crossed[at].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["id", "section", "n_chars", "n_tokens", "doc_tokens", "crossing"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in portions(batch.column("t")):
                part = batch.slice(start, end - start)
                yield rows_of(part.column("id"), [t or "" for t in part.column("t").to_pylist()])

    added = out_schema("section string, n_chars long, n_tokens double, doc_tokens long, crossing long")
    df = source.mapInArrow(run, StructType([source.schema["id"], *added.fields]))
    return df.withColumnRenamed("id", id_)
