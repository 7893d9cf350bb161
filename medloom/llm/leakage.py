"""Held-out passages inside a corpus: template windows joined by hash, then the slots and the words checked.

Names, numbers and units become typed placeholders: in the items by their form, in documents also every word that no
item has, as it may stand for a name. So a copy whose names or figures were changed still shares its windows. The
windows of the items form a sorted hash table that travels to the executors; every window of every document probes it,
in one pass over the corpus for all items that a table holds (ITEM_WORDS words of items). Windows that agree with an
item on about the same diagonal make a candidate; its words are then compared, slots are checked for one consistent
replacement per value, every number and unknown word counting as the value it is, and the longest dense stretch is
measured against the item's length. Items of fewer words than a window are windows of their own length; a stretch of
fewer than LEAST words counts only if it is the whole item.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.operators.units import UNITS, VOLUMES

#: Words in a window; words of items held in one table (some 100 MB); least part of an item's words; least part of equal
#: words in a stretch; words that a stretch needs unless it is the whole item.
WINDOW, ITEM_WORDS, SHARE, DENSITY, LEAST = 5, 4_000_000, 1 / 3, 0.7, 7
#: Meetings of a document's windows with items that are counted at once; a stock phrase of many items has many.
MEETINGS = 1 << 20
#: Words whose codes are kept from one document to the next.
KEPT = 1 << 18
#: Diagonals this far apart may belong to one stretch: words lost or added by layout move it.
BAND = 8

#: Number words.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty "
    "seventy eighty ninety hundred thousand first second third"
).split()

_NUMBER_WORDS = frozenset(NUMBER_WORDS)
_NAME, _NUMBER, _UNIT = 1, 2, 3
_TAG = re.compile(r"<[^<>]*>")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")
_BROKEN = re.compile(r"(?<=\w)-[ \t\r]*\n[\s>|*#]*(?=\w)")
_WORD = re.compile(r"[^\W_]+")
_MIDDLE = re.compile(r"(?<=[a-z,] )[A-Z][^\W_]*(?:-[A-Z][^\W_]*)*")
_PRIME, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x51ED270B)
#: An item's diagonals are numbered from here on, each item's in a range of its own; so many bands has the range.
_ZERO, _DIAGONALS = 1 << 30, 1 << 40
_BANDS = _DIAGONALS // BAND
#: A code that no word has.
_NO_WORD = np.iinfo(np.int64).min


def plain_words(text: str) -> list[str]:
    """Words in lower case, without markup, invisible characters and hyphens at line ends."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    if "-" in text and "\n" in text:
        text = _BROKEN.sub("", text)
    return _WORD.findall(text.lower())


def _number(word: str) -> bool:
    return word[0].isdigit() or word in _NUMBER_WORDS


class _Codes(dict):
    """Code of every word seen so far: its place in the vocabulary, or a number of its own below zero, even for figures, odd for words."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary, self.own = vocabulary, 0

    def __missing__(self, word: str) -> int:
        code = self.vocabulary.get(word)
        if code is None:
            code = -2 * self.own - (2 if _number(word) else 3)
            self.own += 1
        self[word] = code
        return code


def _hashes(kind: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` kinds of words."""
    n = max(0, len(kind) - width + 1)
    mixed, h = kind * (kind + _STEP), np.full(n, width, np.uint64)
    for k in range(width):
        h = h * _PRIME + mixed[k : k + n]
    return h


def _before(sizes: np.ndarray) -> np.ndarray:
    """Sum of the sizes before each."""
    return np.cumsum(sizes) - sizes


class Index:
    """Hash table of the template windows of a set of items."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.window = window
        words = [(i, plain_words(t)) for i, t in items if t]
        words = [(i, w) for i, w in words if w]
        capital = {p for _, t in items if t for m in _MIDDLE.findall(t) for p in _WORD.findall(m.lower())}
        small = {w for _, t in items if t for w in re.findall(r"(?<![^\s(])[a-z][^\W_]*", t)}
        names = capital - small
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in words for w in ws}))}
        units = {u for u in (*UNITS, *VOLUMES) if u.isalpha() and len(u) > 1}
        kind = np.arange(len(self.vocabulary), dtype=np.uint64) + np.uint64(4)
        for w, k in self.vocabulary.items():
            if _number(w):
                kind[k] = _NUMBER
            elif w in units:
                kind[k] = _UNIT
            elif w in names:
                kind[k] = _NAME
        self.kind = kind
        self.ids = np.array([i for i, _ in words], dtype=np.int64)
        self.codes = [self.encode(w) for _, w in words]
        sizes = np.array([len(w) for _, w in words], dtype=np.int64)
        self.need = np.maximum(np.ceil(sizes * SHARE).astype(np.int64), np.minimum(sizes, LEAST))
        hashes, owner, at = [], [], []
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        windows = np.ones(len(words), np.int64)
        for n, c in enumerate(self.codes):
            width = min(window, len(c))
            h, firm = self.windows(c, width)
            telling = np.flatnonzero(firm >= min(2, width))
            if len(telling) < min(3, len(h)):  # hardly a word but names and figures: all it has
                telling = np.arange(len(h))
            windows[n] = len(telling)
            self.grams.append((h[telling], telling))
            hashes.append(h[telling]), owner.append(np.full(len(telling), n)), at.append(telling)
        self.widths = sorted({min(window, len(c)) for c in self.codes})
        #: windows that must agree: three, as far as the item has them, or what the least stretch holds even where every window's length one word differs
        self.enough = np.maximum(np.minimum(3, np.maximum(1, windows)), np.minimum(windows, self.need // window))
        joined = np.concatenate(hashes) if hashes else np.array([], np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hashes, starts = np.unique(joined[order], return_index=True)
        self.starts = np.r_[starts, len(order)]
        self.owner = (np.concatenate(owner) if owner else np.array([], np.int64))[order].astype(np.int64)
        self.at = (np.concatenate(at) if at else np.array([], np.int64))[order].astype(np.int64)
        self.__dict__.pop("_known", None)  # executors make their own

    def encode(self, words: list[str]) -> np.ndarray:
        """Place of each word in the vocabulary; others get numbers of their own below zero, even ones for figures, odd ones for words."""
        known = self.__dict__.get("_known")
        if known is None or len(known) > KEPT:
            known = self._known = _Codes(self.vocabulary)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        unknown = np.where(codes % 2 == 0, np.uint64(_NUMBER), np.uint64(_NAME))
        return np.where(codes < 0, unknown, self.kind[np.maximum(codes, 0)]) if len(self.kind) else unknown

    def windows(self, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``width`` words, and how many of its words aren't placeholders."""
        kind = self.kinds(codes)
        telling = np.concatenate([[0], np.cumsum(kind > _UNIT)])
        return _hashes(kind, width), telling[width:] - telling[:-width]

    def find(self, text: str) -> list[tuple[int, float, float]]:
        """(item, share of its words in the longest stretch, part of its slots that are kept or consistently replaced)."""
        codes = self.encode(plain_words(text))
        if not len(codes) or not len(self.hashes):
            return []
        kind = self.kinds(codes)
        each = [_hashes(kind, w) for w in self.widths]
        h, where = np.concatenate(each), np.concatenate([np.arange(len(x)) for x in each])
        place = np.searchsorted(self.hashes, h)
        place[place == len(self.hashes)] = 0
        met = np.flatnonzero(self.hashes[place] == h)
        if not len(met):
            return []
        found: dict[int, tuple[float, float]] = {}
        for n, shifts in self._dense(codes, self._candidates(place[met], where[met], h, where)):
            result = self._stretch(n, codes, shifts)
            if result and result > found.get(n, (0, 0)):
                found[n] = result
        return [(int(self.ids[n]), share, slots) for n, (share, slots) in found.items()]

    def _candidates(self, place: np.ndarray, at: np.ndarray, h: np.ndarray, where: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Items that the document's windows meet often enough on a band of diagonals and the next, and these diagonals."""
        many = self.starts[place + 1] - self.starts[place]
        if many.sum() > MEETINGS:  # only the cells are held, diagonals are looked up again
            cells, counts = self._cells(place, at)
            order = np.argsort(h, kind="stable")
            h, where = h[order], where[order]
        else:
            diagonals, each = np.unique(self._meetings(place, at, many), return_counts=True)
            cells = diagonals // BAND
            first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            cells, counts, ends = cells[first], np.add.reduceat(each, first), np.append(first[1:], len(each))
            order = None
        both = counts.copy()
        beside = np.flatnonzero(cells[1:] == cells[:-1] + 1)
        both[beside] += counts[beside + 1]
        for k in np.flatnonzero(both >= self.enough[cells // _BANDS]):
            n = int(cells[k] // _BANDS)
            if order is None:
                next_ = k + 1 < len(cells) and cells[k + 1] == cells[k] + 1
                yield n, diagonals[first[k] : ends[k + 1 if next_ else k]] - (n * _DIAGONALS + _ZERO)
            else:
                grams, own = self.grams[n]
                low, high = np.searchsorted(h, grams, "left"), np.searchsorted(h, grams, "right")
                shift = where[np.repeat(low - _before(high - low), high - low) + np.arange((high - low).sum())] - np.repeat(own, high - low)
                band = (n * _DIAGONALS + shift + _ZERO) // BAND - cells[k]
                yield n, np.unique(shift[(band == 0) | (band == 1)])

    def _meetings(self, place: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Item and diagonal, as one number, of every meeting of the document's windows with windows of items."""
        post = np.repeat(self.starts[place] - _before(many), many) + np.arange(many.sum())
        return self.owner[post] * _DIAGONALS + (np.repeat(at, many) - self.at[post] + _ZERO)

    def _cells(self, place: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (item and band of diagonals) that the document's windows meet, in order, and how often; MEETINGS at a time."""
        many = self.starts[place + 1] - self.starts[place]
        cuts = np.flatnonzero(np.diff(np.cumsum(many) // MEETINGS)) + 1
        parts = [np.unique(self._meetings(p, a, m) // BAND, return_counts=True) for p, a, m in zip(np.split(place, cuts), np.split(at, cuts), np.split(many, cuts))]
        every, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return every, np.bincount(back, np.concatenate([k for _, k in parts])).astype(np.int64)

    def _dense(self, codes: np.ndarray, candidates: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        """Candidates of which enough words are equal on some diagonal for a stretch to be long and dense enough; many compared at once."""
        held, words = [], 0
        for n, shifts in candidates:
            held.append((n, shifts))
            words += len(self.codes[n]) * len(shifts)
            if words > MEETINGS:
                yield from self._compare(codes, held)
                held, words = [], 0
        if held:
            yield from self._compare(codes, held)

    def _compare(self, codes: np.ndarray, held: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        items, shifts = [self.codes[n] for n, _ in held], np.concatenate([s for _, s in held])
        sizes, each = np.array([len(c) for c in items]), np.array([len(s) for _, s in held])
        begin = _before(sizes)
        # a row for every word of an item on every diagonal of its candidate
        long = np.repeat(sizes, each)
        inside = np.arange(long.sum()) - np.repeat(_before(long), long)
        word = np.repeat(np.repeat(begin, each), long) + inside
        there = inside + np.repeat(shifts, long)
        there[(there < 0) | (there >= len(codes))] = len(codes)
        same = np.zeros(sizes.sum(), bool)
        same[word[np.append(codes, _NO_WORD)[there] == np.concatenate(items)[word]]] = True
        enough = np.add.reduceat(same, begin, dtype=np.int64) >= DENSITY * self.need[[n for n, _ in held]]
        return (held[k] for k in np.flatnonzero(enough))

    def _stretch(self, n: int, codes: np.ndarray, shifts: np.ndarray) -> tuple[float, float] | None:
        item, size = self.codes[n], len(codes)
        spans = [(max(0, -int(s)), min(len(item), size - int(s)), int(s)) for s in shifts]
        same = np.zeros(len(item), bool)
        for a, b, s in spans:
            if a < b:
                same[a:b] |= codes[a + s : b + s] == item[a:b]
        if np.count_nonzero(same) < DENSITY * self.need[n]:
            return None  # no stretch can be long and dense enough
        slot, other, kind, kinds = np.zeros(len(item), bool), np.zeros(len(item), np.int64), self.kind[item], self.kinds(codes)
        for a, b, s in spans:
            if a < b:
                there = codes[a + s : b + s]
                alike = (there != item[a:b]) & (kind[a:b] <= _UNIT) & (kinds[a + s : b + s] == kind[a:b])
                slot[a:b] |= alike
                other[a:b][alike] = there[alike]
        slot &= ~same
        # a slot counts half against the stretch if its value is replaced alike wherever it occurs, else as a wrong word
        pairs: dict[int, set[int]] = {}
        for a, b in zip(item[slot], other[slot]):
            pairs.setdefault(int(a), set()).add(int(b))
        consistent = np.array([bool(x) and len(pairs[int(a)]) == 1 for a, x in zip(item, slot)], dtype=bool)
        gain = np.where(same, 1.0, np.where(consistent, -1.0, -2.0))
        total = np.r_[0.0, np.cumsum(gain)]
        low = np.minimum.accumulate(total)
        end = int(np.argmax(total - low))
        start = int(np.argmin(total[: end + 1]))
        size = end - start
        if size < self.need[n] or same[start:end].sum() < DENSITY * size:
            return None
        slots = (self.kind[item[start:end]] <= _UNIT).sum()
        kept = (same[start:end] & (self.kind[item[start:end]] <= _UNIT)).sum() + consistent[start:end].sum()
        return size / len(item), float(kept / slots) if slots else 1.0


def _finder(state) -> Callable:  # noqa: ANN001
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Index.__new__(Index)
        table.__dict__.update(state.value)
        for batch in batches:
            rows = [(i, d, s, k) for d, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()) if t for i, s, k in table.find(t)]
            if rows:
                item, doc, share, kept = zip(*rows)
                yield pa.RecordBatch.from_pydict({"item_id": pa.array(item, pa.int64()), "doc_id": pa.array(doc, pa.int64()), "share": pa.array(share, pa.float64()), "slots_kept": pa.array(kept, pa.float64())})

    return find


def leaks(documents: DataFrame, items: DataFrame, item_words: int = ITEM_WORDS) -> DataFrame:
    """``item_id, doc_id, share, slots_kept``: documents (``doc_id, text``) that repeat a stretch of an item (``item_id, text``).

    The stretch has at least SHARE of the item's words, in order, of which at least DENSITY are equal; ``share`` is its
    length over the item's. Null and empty texts on either side take no part; items of equal text are all reported.
    Every document is read whole, once for every ``item_words`` words of items.
    """
    spark = documents.sparkSession
    held = items.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(r"\S+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-held // item_words))
    found = None
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).select("item_id", "text").collect()  # about `item_words` words
        index = spark.sparkContext.broadcast(vars(Index([(r[0], r[1]) for r in rows])))
        part = documents.select("doc_id", "text").mapInArrow(_finder(index), "item_id bigint, doc_id bigint, share double, slots_kept double")
        found = part if found is None else found.unionAll(part)
    return found
