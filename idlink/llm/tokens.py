"""Encoding of whole texts with a public tokenizer file, with repeated words encoded once per worker.

The byte-level tokenizers used here split a text before merging, and a single blank between two other
characters always starts a new part. So a text is cut at such blanks, and every distinct part is encoded
by the library once. The result is that of encoding the whole text; texts in which cutting would not be
safe (special tokens) are encoded whole. A line feed without white space beside it is a part of its own, so
such a text is also cut in front of it, and the word behind it is one without a blank in front.

Arrow cuts the texts of a batch and numbers their distinct parts, so Python sees a part once a batch, not at each place.
"""

from __future__ import annotations

import json
import os
import re
import string
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

DEFAULT = "byte_bpe_50k.json"
#: White space next to white space; such a text is cut only at the other blanks.
_CLUSTER = re.compile(r"\s\s")
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
_PARTS = regex.compile(public_tokenizers.PATTERN)
#: Below this character, the parts of a text are the same in all Unicode versions.
_AGREED = "ɐ"
_LATER = re.compile(f"[{_AGREED}-\U0010ffff]")
#: Signs behind the letters of a word that ends with them are one part of their own.
_SIGNS = string.punctuation
_ENDED = rf"^\n?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+[!-/:-@\[-`{{-~]+$"
#: White space of one byte, and bytes that other white space begins with.
_SPACE, _WIDE = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Entries that a worker keeps, some 200 bytes each; beyond it the cache starts anew.
CACHE = 750_000

_loaded: dict[str, IdEncoder] = {}
#: Words merged in one call.
_AT_ONCE = 64
#: Parts pieces of a batch; no piece that is split here has it.
_MARK = "\uffff"
_ID = attrgetter("id")


def _byte_letters() -> np.ndarray:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    letters = np.arange(256, dtype="<u4")
    letters[others] = 256 + np.arange(len(others))
    return letters


class IdEncoder:
    """Little-endian 32-bit ids of whole texts. Pieces that are one part go straight to the library's merge model."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        if made["normalizer"] or made["pre_tokenizer"].get("type") != "ByteLevel" or made["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{name} is not a plain byte-level tokenizer")
        added = {k: str(t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.specials = list(added.values())
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        #: Bytes of text that each id stands for: a letter of the vocabulary is a byte.
        sizes = {k: len(token) for token, k in self.tokenizer.get_vocab().items()} | {k: len(t.encode()) for k, t in added.items()}
        self.sizes = np.zeros(max(sizes) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        #: For a blank and a line feed: which ids begin with it, if words behind them can be merged as one text.
        plain = not any(made["model"].get(k) for k in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        self.begins = {front: self._beginners(front, len(self.sizes)) for front in " \n" if plain}

    def _beginners(self, front: str, n: int) -> np.ndarray | None:
        """Whether each id begins with `front`. None if a token holds the end of a word and the `front` behind it."""
        byte_of = {chr(letter): byte for byte, letter in enumerate(self.letters)}
        mark, out = self._lettered(front), np.zeros(n, bool)
        for token, k in self.tokenizer.get_vocab().items():
            out[k] = token.startswith(mark)
            before = token.lstrip(mark).partition(mark)
            if before[1] and before[0]:
                word = bytes(byte_of[c] for c in before[0]).decode(errors="replace")
                if word.replace("\ufffd", "").isalpha() or "\ufffd" in word:
                    return None
        return out

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def cut(self, text: str) -> list[str] | None:
        """Parts of a text; all but the first had a blank in front, or begin with a line feed. None: encode it whole."""
        if any(s in text for s in self.specials):
            return None
        return _SINGLE.split(text) if _CLUSTER.search(text) else text.replace("\n", " \n").split(" ")

    def _known(self, known: dict[str, bytes], parts: pa.Array, front: str) -> pa.Array:
        """Ids of distinct parts, learned where new. A word and signs behind it, or what spans lines, is not kept as a whole."""
        ended = np.flatnonzero(pc.match_substring_regex(parts, _ENDED).to_numpy(zero_copy_only=False)).tolist()
        stems = parts.to_numpy(zero_copy_only=False).tolist()
        signs = []
        for k in ended:
            part = stems[k]
            stems[k] = part.rstrip(_SIGNS)
            signs.append(part[len(stems[k]) :])
        ids = list(map(known.get, stems))
        missing = [k for k, found in enumerate(ids) if found is None]
        new = {stems[k] for k in missing}
        self._merge(known, new, front)
        for k in missing:
            ids[k] = known[stems[k]]
        for part in new:
            if "\n" in part[1:]:
                del known[part]
        self._learn(set(signs))
        for k, sign in zip(ended, signs):
            ids[k] += self.pieces[sign]
        return pa.array(ids, pa.large_binary())

    def _merge(self, known: dict[str, bytes], new: set[str], front: str) -> None:
        words = [p for p in new if p.isalpha()]  # one piece each
        known.update(zip(words, self._ids([front + p for p in words], front)))
        new = [p for p in new if not p.isalpha()]
        if front:  # a line feed stands in place of the blank
            lines = [p for p in new if p[0:1] == "\n" and p[1:].isalpha()]
            known.update(zip(lines, self._ids(lines, "\n")))
            new = [p for p in new if not (p[0:1] == "\n" and p[1:].isalpha())]
        # Pieces are split here only where all Unicode versions agree.
        texts = [p if p[:1] == "\n" else front + p for p in new]
        split = [[t] if _LATER.search(t) else _PARTS.findall(t) for t in texts]
        self._learn(set().union(*split))
        of = self.pieces.__getitem__
        known.update({part: b"".join(map(of, pieces)) for part, pieces in zip(new, split)})

    def _learn(self, pieces: set[str]) -> None:
        missing = list(pieces.difference(self.pieces))
        self.pieces.update(zip(missing, self._ids(missing)))

    def _ids(self, pieces: list[str], front: str = "") -> list[bytes]:
        """Ids of pieces that are one part each, or, with odd characters, any texts. All begin with `front`."""
        if _LATER.search("".join(pieces)):
            odd = [p for p in pieces if _LATER.search(p)]
            found = dict(zip(odd, self.whole(odd)))
            plain = [p for p in pieces if p not in found]
            found.update(zip(plain, self._merged(plain, front)))
            return [found[p] for p in pieces]
        return self._merged(pieces, front)

    def _lettered(self, text: str) -> str:
        return self.letters[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")

    def _merged(self, pieces: list[str], front: str = "") -> list[bytes]:
        """Ids of pieces that are one part each. Words with a `front` are merged many at once, as no token spans two."""
        if not pieces:
            return []
        begins = self.begins.get(front) if front else None
        if begins is not None:
            merge = self.tokenizer.model.tokenize
            texts = [self._lettered("".join(pieces[at : at + _AT_ONCE])) for at in range(0, len(pieces), _AT_ONCE)]
            ids = np.fromiter(map(_ID, chain.from_iterable(map(merge, texts))), "<u4")
            ends = [*(4 * np.flatnonzero(begins[ids])).tolist(), 4 * len(ids)]
            flat = ids.tobytes()
            return [flat[a:b] for a, b in zip(ends, ends[1:])]
        as_letters = self._lettered(_MARK.join(pieces)).split(self._lettered(_MARK))
        merge = self.tokenizer.model.tokenize
        ids = [[t.id for t in merge(piece)] for piece in as_letters]
        flat = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = list(accumulate(map(len, ids), initial=0))
        return [flat[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts Arrow cannot cut: those that may have white space next to white space, or a special token."""
        odd = np.zeros(len(texts), bool)
        for special in self.specials:
            odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if ends[0] == ends[-1]:
            return odd
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        space = _SPACE[raw]
        pairs = np.flatnonzero(space[1:] & space[:-1])
        odd[np.searchsorted(ends, pairs + ends[0], "right") - 1] = True
        wide = np.zeros(len(texts), bool)
        wide[np.searchsorted(ends, np.flatnonzero(_WIDE[raw]) + ends[0], "right") - 1] = True
        rows = np.flatnonzero(wide & ~odd)
        odd[rows] = [_CLUSTER.search(t) is not None for t in texts.take(pa.array(rows)).to_pylist()]
        return odd

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if len(self.parts) + len(self.heads) + len(self.pieces) > CACHE:
            self.forget()
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        out = [b""] * len(texts)
        if not out:
            return out
        odd = self._odd(texts)
        odd_rows, odd_texts = np.flatnonzero(odd).tolist(), texts.filter(pa.array(odd)).to_pylist()
        cut = [self.cut(t) for t in odd_texts]
        lists = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \n"), " ")
        rows = np.flatnonzero(~odd).tolist() + [k for k, c in zip(odd_rows, cut) if c is not None]
        cut_parts = pa.array(list(chain.from_iterable(c for c in cut if c is not None)), pa.large_string())
        parts = pa.concat_arrays([lists.flatten(), cut_parts])
        sizes = np.concatenate([pc.list_value_length(lists).to_numpy(), np.array([len(c) for c in cut if c is not None], np.int64)])
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        if rows:
            for row, ids in zip(rows, self._joined(parts, bounds)):
                out[row] = ids
        special = [k for k, c in enumerate(cut) if c is None]
        for k, whole in zip(special, self.whole([odd_texts[k] for k in special])):
            out[odd_rows[k]] = whole
        return out

    def _joined(self, parts: pa.Array, bounds: np.ndarray) -> list[bytes]:
        """Ids of texts from their parts; text i has `bounds[i]:bounds[i + 1]`, of which the first has no blank in front."""
        firsts = bounds[:-1]
        behind = np.ones(len(parts), bool)
        behind[firsts] = False
        heads = parts.take(pa.array(firsts)).dictionary_encode()
        coded = pc.if_else(pa.array(behind), parts, pa.scalar(None, pa.large_string())).dictionary_encode()
        known = pa.concat_arrays([self._known(self.parts, coded.dictionary, " "), self._known(self.heads, heads.dictionary, "")])
        places = coded.indices.fill_null(0).to_numpy().copy()
        places[firsts] = len(coded.dictionary) + heads.indices.to_numpy()
        ids = known.take(pa.array(places))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset + bounds].tolist()
        flat = memoryview(ids.buffers()[2] or b"")
        return [bytes(flat[a:b]) for a, b in zip(ends, ends[1:])]

    def forget(self) -> None:
        """Gives the memory of all known parts back; they are learned anew when met."""
        self.parts, self.heads, self.pieces = {}, {}, {}

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the tokens of all texts, in characters of the joined texts, and the number of each text's tokens.

        A token that is a part of a character's bytes has the span of that character.
        """
        found = self.encode(texts)
        sizes = self.sizes[np.frombuffer(b"".join(found), "<u4")]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(sizes)
        spans = np.column_stack([character[ends - sizes], character[ends - 1] + 1]) if len(ends) else np.empty((0, 2), np.int64)
        return spans, np.array([len(x) // 4 for x in found], np.int64)


def id_encoder(name: str) -> IdEncoder:
    """The encoder stays in the worker between tasks."""
    if name not in _loaded:
        _loaded[name] = IdEncoder(name)
    return _loaded[name]


def forget() -> None:
    """What the worker's encoders know is given back: a worker that goes on to other work would hold it."""
    for encoder in _loaded.values():
        encoder.forget()
