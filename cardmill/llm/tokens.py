"""Token ids of whole texts with the tokenizers library, with a bounded memory of known pieces."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cardmill.llm.common import KEPT

#: Pieces remembered by one Python worker (about 250 bytes each).
MEMORY_PIECES = 1_000_000
#: Pieces that are handed to the library at once.
AT_ONCE = 4096

_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ASCII_WORDS = re.compile("[^\\t-\\r ]+")
_SPACED_WORDS = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")

_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Texts with other white space than single spaces and line feeds between words.
_NOT_SINGLE = (
    "[\\x00\\t\\x0b-\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
    "|[ \\n][ \\n]|\\A[ \\n]|[ \\n]\\z"
)
#: Letters that stay one character in lower case and in NFC, then other ASCII characters that are
#: neither digits nor apostrophes: both kinds of vocabulary take either run as one.
_LETTERS = "".join(c for c in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]) if c.isalpha())
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PLAIN = "\\A ?[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{ff}]+[!-&(-/:-@\\[-`{-~]*\\z"


def _cut_words(text: str) -> list[str]:
    """Words between white space, which is dropped."""
    if any(c in text for c in _SEPARATORS):  # white space to Python only
        return _ASCII_WORDS.findall(text)
    return text.split()


def _cut_spaced(text: str) -> list[str]:
    """Words with the space before them, and other white space."""
    if "\x00" not in text and text.replace("\n", " ").split(" ") == text.split():
        # Only single spaces and line feeds between words.
        return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")
    return _SPACED_WORDS.findall(text)


#: The worker's encoder, of one vocabulary at a time.
OPEN: dict[str, "Encoder"] = {}
KEPT["encoder"] = OPEN


def _listed(values: pa.Array) -> list:
    """The values as Python objects; faster than ``to_pylist``, which makes a scalar of each."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _whole(text: str) -> list[str]:
    return [text]


class Encoder:
    """Encodes a text as the ids of its pieces, where pieces are cut so that ids do not change.

    Both kinds of vocabulary split a text before merging anything: one drops white space, the
    other joins a single space to the word after it. Cutting there as well gives the same ids,
    and most pieces recur. A vocabulary of neither kind encodes whole texts.
    """

    def __init__(self, path: str, most: int = MEMORY_PIECES):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        self.cut = self._cut(kind)
        special = [re.escape(t["content"]) for t in kind.get("added_tokens", [])]
        self.plain = self._without_rules(path, kind["model"].get("end_of_word_suffix") or "")
        self.special_texts = [t["content"] for t in kind.get("added_tokens", [])]
        self.special = re.compile(f"({'|'.join(special)})") if special and self.cut is not _whole else None
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _cut(kind: dict):
        before, normal = kind.get("pre_tokenizer") or {}, kind.get("normalizer") or {}
        plain = all(
            not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and not re.search(r"\s", t["content"])
            for t in kind.get("added_tokens", [])
        )
        steps = [step.get("type") for step in normal.get("normalizers", [])]
        if plain and before.get("type") == "ByteLevel" and before.get("use_regex") and not normal and not before["add_prefix_space"]:
            return _cut_spaced
        split = (before.get("pretokenizers") or [{}])[0]
        drops = split.get("behavior") == "Removed" and split.get("invert") and "\\s" in str(split.get("pattern"))
        if plain and drops and steps == ["NFC", "Replace", "Lowercase"]:
            return _cut_words
        return _whole

    def _pieces(self, text: str) -> list[str]:
        if self.special and self.special.search(text):  # special tokens are taken out before anything else
            parts = self.special.split(text)
            return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else self.cut(part))]
        return self.cut(text)

    def _without_rules(self, path: str, suffix: str):
        """The same merges without the rules that normalise and split a text first. ``widths`` has the
        bytes that each id stands for."""
        if self.cut is _whole:
            return None
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocabulary = plain.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, n in vocabulary.items():  # byte-level: one character a byte
            self.widths[n] = len(token.removesuffix(suffix))
        return plain

    def _runs(self, runs: pa.Array) -> pa.Array:
        """Ids of runs that no rule changes or splits."""
        wanted = np.cumsum(pc.binary_length(runs).to_numpy(zero_copy_only=False).astype(np.int64))
        found, ends, before = [], [np.zeros(1, np.int64)], 0
        for at in range(0, len(runs), AT_ONCE):  # the library's answers are many times as large as the ids
            part = _listed(runs.slice(at, AT_ONCE))
            encoded = self.plain.encode_batch_fast([part], add_special_tokens=False, is_pretokenized=True)[0]
            ids = np.array(encoded.ids, "<u4")
            reach, own = np.cumsum(self.widths[ids]), wanted[at : at + AT_ONCE] - (wanted[at - 1] if at else 0)
            end = np.searchsorted(reach, own) + 1
            if not np.isin(own, reach).all():  # bytes outside the vocabulary
                encoded = self.plain.encode_batch([part], add_special_tokens=False, is_pretokenized=True)[0]
                ids = np.array(encoded.ids, "<u4")
                end = np.cumsum(np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(part)))
            found.append(ids.tobytes())
            ends.append(4 * (before + end))
            before += len(ids)
        offsets = np.concatenate(ends)
        return pa.Array.from_buffers(pa.large_binary(), len(runs), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(found))])

    def _fresh(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces met for the first time."""
        plain = np.zeros(len(pieces), bool)
        if self.plain:
            plain = pc.match_substring_regex(pieces, _PLAIN).to_numpy(zero_copy_only=False)
        own = pieces.filter(pa.array(plain))
        stems, tails = pc.ascii_rtrim(own, _MARKS), pc.utf8_ltrim(own, " " + _LETTERS)
        if self.cut is _cut_words:
            stems = pc.utf8_lower(stems)
        there = pc.not_equal(tails, "")
        runs = pa.concat_arrays([stems, tails.filter(there)]).dictionary_encode()
        ids = self._runs(runs.dictionary)
        which = runs.indices.slice(len(own)).to_numpy()
        tail = np.full(len(own), -1, np.int64)
        tail[there.to_numpy(zero_copy_only=False)] = which
        tail_ids = ids.take(pa.array(tail, mask=tail < 0)).fill_null(b"")
        known = pc.binary_join_element_wise(ids.take(runs.indices.slice(0, len(own))), tail_ids, pa.scalar(b"", pa.large_binary()))
        others = _listed(pieces.filter(pa.array(~plain)))
        ruled = []
        for at in range(0, len(others), AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(others[at : at + AT_ONCE], add_special_tokens=False)
            ruled += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        places = np.zeros(len(pieces), np.int64)
        places[np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]] = np.arange(len(pieces))
        return pa.concat_arrays([known, pa.array(ruled, pa.large_binary())]).take(pa.array(places))

    def _flat_pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The pieces of all texts, how many each text has, and the order of the texts in them:
        those that Arrow cuts come first."""
        rows = pa.array(texts, pa.large_string())
        odd = np.full(len(texts), self.cut is _whole)
        if not odd.any():
            for special in self.special_texts:
                odd |= pc.match_substring(rows, special).to_numpy(zero_copy_only=False)
            if self.cut is _cut_spaced:
                odd |= pc.match_substring_regex(rows, _NOT_SINGLE).to_numpy(zero_copy_only=False)
        simple = rows.filter(pa.array(~odd))
        if self.cut is _cut_spaced:
            simple = pc.replace_substring(pc.replace_substring(simple, "\n", "\x00\n\x00"), " ", "\x00 ")
            cut = pc.split_pattern(simple, "\x00")
        else:
            cut = pc.ascii_split_whitespace(simple)
        lists = [self._pieces(texts[i]) for i in np.flatnonzero(odd)]
        flat = pa.concat_arrays([cut.flatten(), pa.array([p for own in lists for p in own], pa.large_string())])
        sizes = np.r_[pc.list_value_length(cut).to_numpy(zero_copy_only=False), [len(own) for own in lists]]
        return flat, sizes.astype(np.int64), np.r_[np.flatnonzero(~odd), np.flatnonzero(odd)]

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        flat, sizes, order = self._flat_pieces(texts)
        coded = flat.dictionary_encode()
        ids = list(map(self.known.get, _listed(coded.dictionary)))
        missing = np.array([own is None for own in ids], bool)
        places = np.where(missing, len(ids) + np.cumsum(missing) - 1, np.arange(len(ids)))
        new = coded.dictionary.filter(pa.array(missing))
        fresh = self._fresh(new)
        # What is remembered when memory is full are the common pieces; those are kept.
        if self.cut is not _whole and len(self.known) + len(fresh) <= self.most:
            self.known.update(zip(_listed(new), _listed(fresh)))
        every = pa.concat_arrays([pa.array(ids, pa.large_binary()), fresh])
        whole = every.take(pa.array(places[coded.indices.to_numpy()]))
        _, offsets, data = whole.buffers()
        places = np.frombuffer(offsets, np.int64) if len(whole) else np.zeros(1, np.int64)
        ends = places[np.r_[0, np.cumsum(sizes)]].tolist()
        out = [b""] * len(texts)
        for i, a, b in zip(order.tolist(), ends, ends[1:]):
            out[i] = data[a:b].to_pybytes() if b > a else b""
        return out


def encoder(path: str, most: int = MEMORY_PIECES) -> Encoder:
    """The worker's encoder of this vocabulary file, which remembers at most that many pieces."""
    if path not in OPEN or OPEN[path].most != most:
        OPEN.clear()
        OPEN[path] = Encoder(path, most)
    return OPEN[path]
