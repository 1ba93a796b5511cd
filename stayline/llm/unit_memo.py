"""Token ids of whole columns of text, each distinct unit encoded once.

A unit is a stretch of text that no token crosses, by the rules of the tokenizer's
own file; where the rules are not known to allow it, whole texts are encoded. The
bytes of many texts are cut as one NumPy array, units are dictionary-encoded by
Arrow, and only units not met before go to the tokenizers library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stayline.llm.common import per_process
from stayline.llm.rolling import column_bytes

#: Units remembered before a worker starts anew.
MEMO_UNITS = 600_000
#: Bytes cut into units at a time.
PIECE = 1 << 21

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
#: White space beyond ASCII, and controls that engines class in different ways.
UNUSUAL = r"[\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

WHOLE, DROPPED, LEADING = "whole", "dropped", "leading"


def unit_rule(spec: dict) -> str:
    """How texts may be cut: blanks ``dropped`` between pre-tokens, a blank ``leading`` its word, or ``whole`` texts."""
    normal, cuts = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or spec.get("truncation") or spec.get("padding"):
        return WHOLE
    if normal is None and cuts.get("type") == "ByteLevel" and cuts.get("use_regex") and not cuts["add_prefix_space"]:
        return LEADING
    steps = (normal or {}).get("normalizers", [])
    cuts = cuts.get("pretokenizers", [])
    first = cuts[0] if cuts else {}
    fits = (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": "\\s+"}, " ")
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (first["behavior"], first["invert"]) == ("Removed", True)
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and first["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    )
    return DROPPED if fits else WHOLE


def encoder_arguments(path: str, plain_specials: bool = False) -> tuple:
    """What :class:`UnitEncoder` needs, read once on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return path, unit_rule(spec), tuple(t["content"] for t in spec["added_tokens"]), plain_specials


def unit_encoder(arguments: tuple) -> UnitEncoder:
    """The encoder of this worker process: its memo outlasts tasks."""
    return per_process(("unit encoder", *arguments), lambda: UnitEncoder(*arguments))


def pieces(raw: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Borders of about ``size`` bytes; each cut lies before a blank that follows a word, which no unit crosses."""
    lo = 0
    while lo < len(raw):
        hi = lo + size
        while hi < len(raw):
            blank = BLANK[raw[hi - 1 : hi + 4096]]
            cut = np.flatnonzero(blank[1:] & ~blank[:-1])
            if len(cut):
                hi += int(cut[0])
                break
            hi += 4096
        yield lo, min(hi, len(raw))
        lo = hi


#: Kinds of bytes: blanks, Latin letters, digits, other signs, and those whose words only the library may cut.
LETTER, DIGIT, SIGN, HARD = 1, 2, 3, 4
KINDS = np.full(256, HARD, np.uint8)
KINDS[0x21:0x7F] = SIGN
KINDS[BLANK] = 0
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[0x27] = HARD  # an apostrophe may open a contraction


def kinds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and which are second bytes of a letter of Latin-1 (all but the two signs among them)."""
    kind = KINDS[raw]
    second = np.zeros(len(raw), bool)
    second[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    kind[second] = LETTER
    kind[:-1][second[1:]] = LETTER
    return kind, second


def units(raw: np.ndarray, first: np.ndarray, rule: str) -> tuple[pa.Array, np.ndarray]:
    """Units and where they start; ``first`` marks the first byte of each text.

    Words without hard bytes are cut between letters, digits and signs. Under
    ``dropped`` digits stand alone, blanks go and simple words are lower-cased.
    Under ``leading`` a space joins the word after it; of a longer run of blanks
    before a word all but the last are one unit, and a run at the end of a text
    is one, as GPT-2's pattern has it.
    """
    kind, second = kinds(raw)
    blank = kind == 0
    before = np.concatenate([[True], blank[:-1]]) | first
    word = np.cumsum(before & ~blank)
    hard = np.zeros(int(word[-1]) + 1 if len(word) else 1, bool)
    hard[word[kind == HARD]] = True
    simple = ~hard[word] & ~blank
    inner = np.zeros(len(raw), bool)
    inner[1:] = simple[1:] & ~before[1:] & ((kind[1:] != kind[:-1]) | ((kind[1:] == DIGIT) & (rule == DROPPED)))
    if rule == DROPPED:
        at = np.flatnonzero((before & ~blank) | inner)
        offsets = np.concatenate([[0], np.cumsum(~blank)])[np.append(at, len(raw))].astype(np.int32)
        small = raw + np.uint8(32) * (simple & (((raw >= 0x41) & (raw <= 0x5A)) | (second & (raw <= 0x9E))))
        return _strings(offsets, small[~blank]), at
    word_next = np.concatenate([~blank[1:] & ~first[1:], [False]])
    space_before = np.concatenate([[False], raw[:-1] == 32]) & ~first
    blank_before = np.concatenate([[False], blank[:-1]])
    at = np.flatnonzero(np.where(blank, ~blank_before | word_next, blank_before & ~space_before) | first | inner)
    return _strings(np.append(at, len(raw)).astype(np.int32), raw), at


def _strings(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


#: Letters of Latin-1 as the byte-level alphabet writes their two bytes, and the space.
LATIN = {c: "Ã" + chr(b if b >= 0xA1 else b + 0xA2) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7) for b in [c - 0x40]}
LATIN[0xED] = "ÃŃ"  # 0xAD stands apart in that alphabet
LATIN[0x20] = "Ġ"
#: One pre-token.
SIMPLE = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")


class UnitEncoder:
    """Encodes columns of texts with one ``.json`` tokenizer, without added special tokens."""

    def __init__(self, path: str, rule: str, specials: tuple[str, ...], plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain_specials
        self.rule = rule
        apart = [] if plain_specials else [re.escape(s) for s in specials if s]
        if rule == LEADING:
            apart.append(UNUSUAL)
        self.apart = "|".join(apart)
        self.specials = [] if plain_specials else [s for s in specials if s]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1, np.int64)

    def by_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, units: list[str]) -> list[list[int]]:
        """Ids of units; single pre-tokens of plain letters go straight to the merges."""
        tokenize = self.library.model.tokenize
        found = [
            [t.id for t in tokenize(u if u.isalpha() and u.isascii() else u.translate(LATIN))] if SIMPLE.fullmatch(u) else None
            for u in units
        ]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self.by_library([units[i] for i in rest]), strict=True):
            found[i] = ids
        return found

    def _learn(self, new: list[str]) -> None:
        ids = self._encoded(new)
        ends = self.ends[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.ends[-1]], np.empty(int(ends[-1]) * 2, np.int32)])
        self.flat[self.ends[-1] : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1] - self.ends[-1]))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.ends = np.concatenate([self.ends, ends])

    def _ids(self, cut: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and how many each has."""
        coded = cut.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.place) > MEMO_UNITS:
            self.forget()
        new = [u for u in distinct if u not in self.place]
        for lo in range(0, len(new), 20_000):
            self._learn(new[lo : lo + 20_000])
        row = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        start, n = self.ends[row], np.diff(self.ends)[row]
        stop = np.cumsum(n)
        return self.flat[np.repeat(start - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)], n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); texts must not be null."""
        if not len(texts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        apart = np.ones(len(texts), bool) if self.rule == WHOLE else np.zeros(len(texts), bool)
        if self.rule != WHOLE and self.apart:
            apart = pc.match_substring_regex(texts, self.apart).to_numpy(zero_copy_only=False)
        if not apart.any():
            return self._cut(texts)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(apart):
            out[i] = np.array(self.by_library([texts[int(i)].as_py()])[0], np.int32)
        if not apart.all():
            ids, n = self._cut(texts.filter(pa.array(~apart)))
            for i, part in zip(np.flatnonzero(~apart), np.split(ids, np.cumsum(n)[:-1]), strict=True):
                out[i] = part
        return np.concatenate(out).astype(np.int32), np.array([len(x) for x in out], np.int64)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, borders = column_bytes(texts)
        n_ids = np.zeros(len(texts), np.int64)
        found = []
        begins = np.zeros(len(raw) + 1, bool)
        begins[borders] = True
        for lo, hi in pieces(raw):
            cut, at = units(raw[lo:hi], begins[lo:hi], self.rule)
            ids, n = self._ids(cut)
            # the last text that starts at or before a unit holds it; empty texts start there too but end at once
            owner = np.searchsorted(borders, lo + at, side="right") - 1
            np.add.at(n_ids, owner, n)
            found.append(ids)
        return np.concatenate(found) if found else np.empty(0, np.int32), n_ids
