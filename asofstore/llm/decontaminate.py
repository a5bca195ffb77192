"""Benchmark decontamination by template canonicalisation (operator 9).

Numbers, names and units of benchmark items and documents are replaced by typed
placeholders, so an item whose numbers, names or units were changed still has
the same *template*. A run of names, or of numbers and units, inside a sentence
is one placeholder, so a value may change its number of words. A name is any
capitalised word of a document, wherever it stands, all capitals, an initial, or
a few Han or Katakana signs; a sentence-initial word of
an item (or line-initial: a new line begins a sentence) may or may not be a
name, so its windows are indexed under both readings. Windows of ``window`` canonical words are hash-joined: benchmark
windows are the build side, documents are streamed past it whole.

Windows with fewer than ``least`` plain words under some reading are too weak as
templates and are matched word by word instead (case and outer punctuation
aside). An item without any template window is contaminating only if the
document has all of it in this way, or, where it has two plain words of letters or more, if
its whole template is a whole sentence or line of the document. Names are known
by their shape; a name that a document writes in small letters is none.

Matches of one shift that touch are a segment; segments of an item are chained
in order, from one shift to the next by at most ``window`` words, and what a
chain covers of the item counts together. The **names** of a chain must be
consistent: equal names of the item stand against equal names of the document
and the other way round; sentence-initial words take part only if they are
names elsewhere in the item. Numbers and units may coincide or part; they are
compared by value and by lemma, to count what changed. A document is
contaminated by an item if a consistent chain covers ``coverage`` of the item's
words.

The benchmark is a stated query set: it is read in blocks of at most
``BLOCK_BYTES`` of text, and each block is compared with all documents, so what
is broadcast has a fixed bound whatever the benchmark's size. Documents are
never exchanged.

Defined results: items that are null or have no words match nothing; items of
fewer than ``least`` words match where they are a whole line of the document,
as any text may have such words in it; items shorter than a window are one
window; null or empty documents are clean; repeated rows are judged each for
itself; a null doc_id is carried; extra columns are carried by :func:`clean`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BLOCK_BYTES = 16 << 20
# Words that count as numbers and as units.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
                         "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
                         "eighty ninety hundred thousand million billion dozen half".split())
UNITS = frozenset("mm cm m km mg g kg lb lbs oz ml l inch inches foot feet yard yards mile miles meter meters "
                  "metre metres kilometer kilometers gram grams kilogram kilograms liter liters litre litres "
                  "second seconds minute minutes hour hours day days week weeks month months year years "
                  "percent dollar dollars euro euros cent cents pound pounds degrees celsius fahrenheit "
                  "mph kmh watt watts volt volts".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_WITH_UNIT = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*([^\W\d]+)$")
_EDGE = " \t\n\r.,;:!?\"'()[]{}<>*#|&%$“”‘’«»¿¡"
NUM, NAME, UNIT = (np.uint64(xxhash.xxh3_64_intdigest(x) & ~7) for x in (b"<num>", b"<name>", b"<unit>"))
_KIND, _END = np.uint64(3), np.uint64(4)
_GROUP = np.array([0, 1, 1, 2], np.int8)      # plain, number, unit, name: numbers and units run together


def _is_number(low: str) -> bool:
    """Numbers, number words, both with a unit ('5km') or hyphens ('twenty-five', '5-mile')."""
    def one(part):
        with_unit = _WITH_UNIT.match(part)
        return part in NUMBER_WORDS or _NUMBER.match(part) or (with_unit and with_unit[1] in UNITS)
    if one(low):
        return True
    parts = low.split("-")
    return len(parts) > 1 and all(one(x) or x in UNITS for x in parts) and any(map(one, parts))


# Names by shape: a capital and what follows (McDonald), joined by hyphens or apostrophes (O'Brien, Anne-Marie,
# Mary's), capitals alone (MARY), an initial, or a few signs of a script that has no capitals.
_JOINED = re.compile("[-'\u2019]")
_SIGNS = re.compile("[\u4e00-\u9fff]{2,4}|[\u30a0-\u30ff]{2,12}")


# Abbreviations before a name, which end no sentence.
_TITLES = frozenset("Mr. Mrs. Ms. Dr. Prof. St.".split())


def _ends(word: str) -> bool:
    """The word ends a sentence: a title or an initial does not."""
    return word[-1:] in (".", "!", "?", ":") and not (
        word in _TITLES or (len(word) == 2 and word[1] == "." and word[0].isupper()))


def _is_name(bare: str) -> bool:
    if not bare[:1].isupper():
        return bool(_SIGNS.fullmatch(bare))
    if len(bare) == 1:
        return bare not in "AI"
    first, *rest = _JOINED.split(bare)
    return first.isalpha() and all(x.isalpha() for x in rest) and (
        bare[1:].islower() or all(x[0].isupper() for x in rest))


class _Canonical(C.Remembered):
    """Hash of a word; its low bits say plain, number, unit or name, and whether it ends a sentence."""

    def make(self, word: str) -> int:
        bare = word.strip(_EDGE)
        low = bare.lower()
        code = xxhash.xxh3_64_intdigest((low or word).encode("utf-8", "surrogatepass")) & ~7
        if _is_number(low):
            code |= 1
        elif low in UNITS:
            code |= 2
        elif _is_name(bare):
            code |= 3
        if _ends(word):
            code |= 4
        return code


_CANONICAL = _Canonical()
_ARTICLES = np.array([xxhash.xxh3_64_intdigest(x) & ~7 for x in (b"a", b"an")], np.uint64)


def _plain_form(word: str) -> str:
    return word.strip(_EDGE).lower() or word


def coded(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_CANONICAL.__getitem__, words), np.uint64, len(words))


def exact(raw: np.ndarray) -> np.ndarray:
    """Codes of the words themselves, without case and outer punctuation."""
    return raw & ~np.uint64(7)


def canonical(raw: np.ndarray, plain: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first word of each code, kind of each word); names where ``plain`` is set count as plain."""
    kind = (raw & _KIND).astype(np.int8)
    # 'a dozen': the article belongs to the number
    at = np.flatnonzero(kind[1:] == 1)
    if len(at):
        before = raw[at]
        kind[at[(before == _ARTICLES[0]) | (before == _ARTICLES[1])]] = 1
    if plain is not None:
        kind[plain & (kind == 3)] = 0
    group = _GROUP[kind]
    first = np.ones(len(raw), bool)
    first[1:] = (group[1:] == 0) | (group[1:] != group[:-1]) | ((raw[:-1] & _END) != 0)
    starts = np.flatnonzero(first)
    slot = group[starts]
    quantity = np.where(np.logical_or.reduceat(kind == 1, starts), NUM, UNIT)
    codes = np.where(slot == 0, raw[starts] & ~np.uint64(7), np.where(slot == 2, NAME, quantity))
    return codes, starts, kind


def sentence_starts(text: str) -> np.ndarray:
    """Per word; a new line begins a sentence."""
    out = []
    for line in text.splitlines():
        words = line.split()
        out += [True, *map(_ends, words[:-1])][:len(words)]
    return np.array(out, bool)


def coded_starts(text: str, raw: np.ndarray) -> np.ndarray:
    """:func:`sentence_starts` from the codes of the text's words, which say where a sentence ends."""
    out = np.ones(len(raw), bool)
    out[1:] = (raw[:-1] & _END) != 0
    at = np.cumsum([len(line.split()) for line in text.splitlines()])
    out[at[at < len(raw)]] = True
    return out


_LEMMAS = {"feet": "foot", "inches": "inch", "lbs": "lb", "metre": "meter", "metres": "meter", "kilometer": "km",
           "kilometers": "km", "gram": "g", "grams": "g", "kilogram": "kg", "kilograms": "kg", "litre": "liter",
           "litres": "liter"}
_VALUES = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen "
                                      "fourteen fifteen sixteen seventeen eighteen nineteen".split())}
_VALUES |= {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
_VALUES["half"] = 0.5
_SCALES = {"dozen": 12, "hundred": 100, "thousand": 1000, "million": 10 ** 6, "billion": 10 ** 9}


def _lemma(unit: str) -> str:
    return _LEMMAS.get(unit) or (unit[:-1] if unit[-1:] == "s" and unit[:-1] in UNITS else unit)


def _quantity(words: list[str]) -> list:
    """Values and unit lemmas of a run of numbers and units; successive number words are one value."""
    out, total, current, open_ = [], 0, 0, False
    parts = []
    for word in words:
        low = word.strip(_EDGE).lower()
        with_unit = _WITH_UNIT.match(low)
        if with_unit and with_unit[1] in UNITS:
            parts += [low[:with_unit.start(1)], with_unit[1]]
        elif "-" in low[1:]:
            for x in low.split("-"):
                with_unit = _WITH_UNIT.match(x)
                parts += [x[:with_unit.start(1)], with_unit[1]] if with_unit else [x]
        elif low not in ("a", "an"):
            parts.append(low)
    for x in [*parts, None]:
        if x in _VALUES:
            current, open_ = current + _VALUES[x], True
            continue
        if x in _SCALES:
            if x in ("dozen", "hundred"):
                current = max(current, 1) * _SCALES[x]
            else:
                total, current = total + max(current, 1) * _SCALES[x], 0
            open_ = True
            continue
        if open_:
            out.append(float(total + current))
            total, current, open_ = 0, 0, False
        if x in UNITS:
            out.append(_lemma(x))
        elif x is not None:
            try:
                out.append(float(x.strip("$€£").rstrip(".,:/%").replace(",", "")))
            except ValueError:
                out.append(x)
    return out


def _name(word: str) -> str:
    return re.sub("['’]s$", "", word.strip(_EDGE).lower())


class Index:
    """Template windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], window: int, least: int):
        self.window, self.words, self.ids, self.names, self.readings = window, [], [], [], []
        self.whole, self.lines = [], []        # all of the item is needed; as a line of its own
        self.sentences: dict[bytes, list[tuple]] = defaultdict(list)    # whole-item templates of weak items
        sizes, exact_sizes = (defaultdict(lambda: ([], [], [])) for _ in range(2))
        for item_id, text in items:
            words = (text or "").split()
            if not words:
                continue
            n = len(self.ids)
            begins = sentence_starts(text)
            raw = coded(words)
            sure = canonical(raw, begins)[2]
            self.ids.append(item_id)
            self.words.append(words)
            self.names.append({_name(words[j]) for j in np.flatnonzero(sure == 3)})
            done, any_template = set(), False
            weak = np.zeros(len(words) - min(window, len(words)) + 1, bool)     # exact windows, by first word
            for plain in self._plain_words(begins):
                codes, starts, kind = canonical(raw, plain)
                if codes.tobytes() in done:
                    continue
                done.add(codes.tobytes())
                slot = kind[starts] > 0
                w = min(window, len(codes))
                count = np.concatenate([[0], np.cumsum(~slot)])
                enough = (count[w:] - count[:-w]) >= min(least, w)
                if (~slot).sum() < min(least, window):
                    enough[:] = False
                at = np.flatnonzero(enough)
                any_template |= len(at) > 0
                ends = np.append(starts, len(words))
                for p in np.flatnonzero(~enough):
                    weak[ends[p]:max(ends[p + w] - min(window, len(words)), ends[p]) + 1] = True
                self._add(sizes[w], codes, w, at, len(self.readings))
                self.readings.append((n, ends, kind))
            codes, starts, kind = canonical(raw, begins)
            telling = sum(any(c.isalpha() for c in words[j]) for j in np.flatnonzero(kind == 0))
            if not any_template and (kind > 0).any() and telling >= 2:
                self.sentences[codes.tobytes()].append((n, np.append(starts, len(words)), kind))
            w, at = min(window, len(words)), np.flatnonzero(weak)
            self._add(exact_sizes[w], exact(raw), w, at, len(self.readings))
            self.readings.append((n, np.arange(len(words) + 1), sure))
            self.whole.append(not any_template)
            self.lines.append([_plain_form(x) for x in words] if len(words) < least else None)
        self.sizes, self.exact_sizes = ({w: self._table(*map(np.concatenate, x)) for w, x in part.items()
                                         if any(map(len, x[0]))} for part in (sizes, exact_sizes))

    @staticmethod
    def _add(columns: tuple, codes: np.ndarray, w: int, at: np.ndarray, reading: int) -> None:
        h, i, p = columns
        h.append(C.gram_hashes(codes, w)[at])
        i.append(np.full(len(at), reading))
        p.append(at)

    @staticmethod
    def _plain_words(begins: np.ndarray) -> list[np.ndarray]:
        """Sentence-initial words that are no names, per reading of an item."""
        first = np.zeros_like(begins)
        first[0] = True                        # an item quoted inside a sentence
        return [begins, np.zeros_like(begins), first]

    @staticmethod
    def _table(h: np.ndarray, i: np.ndarray, p: np.ndarray) -> tuple:
        order = np.argsort(h, kind="stable")
        present = np.zeros(1 << 20, bool)
        present[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        return h[order], i[order], p[order], present

    @staticmethod
    def _hits(table: tuple, mine: np.ndarray, hits: dict) -> None:
        h, reading, pos, present = table
        at = np.flatnonzero(present[(mine & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at):
            return
        lo, hi = np.searchsorted(h, mine[at], "left"), np.searchsorted(h, mine[at], "right")
        for a, x, y in zip(at, lo, hi):
            for k in range(x, y):
                hits[int(reading[k]), int(a - pos[k])].append(int(pos[k]))

    def matches(self, text: str | None, coverage: float) -> list[tuple]:
        """(item_id, n_windows, coverage, n_slots, n_changed, first word) per item."""
        words = text.split() if text else []
        if not words:
            return []
        raw = coded(words)
        codes, starts, _ = canonical(raw)
        starts = np.append(starts, len(words))
        segments: dict[int, list[tuple]] = defaultdict(list)
        for w, table in self.sizes.items():
            hits: dict[tuple[int, int], list[int]] = defaultdict(list)
            self._hits(table, C.gram_hashes(codes, w), hits)
            self._segments(hits, w, starts, words, segments)
        if self.exact_sizes:
            codes, starts = exact(raw), np.arange(len(words) + 1)
            for w, table in self.exact_sizes.items():
                hits = defaultdict(list)
                self._hits(table, C.gram_hashes(codes, w), hits)
                self._segments(hits, w, starts, words, segments)
        out = self._weak_items(text, raw, words) if self.sentences else []
        seen = {m[0] for m in out}
        for n, found in sorted(segments.items()):
            if self.ids[n] in seen:
                continue
            if self.lines[n] and not any([_plain_form(x) for x in line.split()] == self.lines[n]
                                         for line in text.splitlines()):
                continue
            best = self._chain(n, found, 1.0 if self.whole[n] else coverage)
            if best:
                out.append((self.ids[n], *best))
        return out

    def _weak_items(self, text: str, raw: np.ndarray, words: list[str]) -> list[tuple]:
        """Items with too few plain words for a window, as whole sentences with other values."""
        out = {}
        begins = coded_starts(text, raw)
        bounds = np.append(np.flatnonzero(begins), len(words))
        for a, b in zip(bounds[:-1], bounds[1:]):
            codes, starts, _ = canonical(raw[a:b], begins[a:b])
            for n, own, kind in self.sentences.get(codes.tobytes(), ()):
                ends = np.append(starts, b - a) + a
                slots = [(int(own[t]), kind[own[t]] == 3, self.words[n][own[t]:own[t + 1]], words[ends[t]:ends[t + 1]])
                         for t in range(len(codes)) if kind[own[t]]]
                if n not in out and self._consistent(n, slots):
                    out[n] = (self.ids[n], 1, 1.0, *self._changes(n, slots), int(a))
        return [out[n] for n in sorted(out)]

    def _segments(self, hits: dict, w: int, starts: np.ndarray, words: list[str], segments: dict) -> None:
        """Hits of one shift that touch: (first and end word of the document, of the item, hits, slots)."""
        for (reading, shift), at in hits.items():
            n, own, kind = self.readings[reading]
            at.sort()
            cut = [0, *(k for k in range(1, len(at)) if at[k] > at[k - 1] + w), len(at)]
            for x, y in zip(cut[:-1], cut[1:]):
                p, q = at[x], at[y - 1] + w
                slots = [(int(own[t]), kind[own[t]] == 3, self.words[n][own[t]:own[t + 1]],
                          words[starts[t + shift]:starts[t + shift + 1]])
                         for t in range(p, q) if kind[own[t]]]
                segments[n].append((int(starts[p + shift]), int(starts[q + shift]), int(own[p]), int(own[q]),
                                    y - x, slots))

    def _consistent(self, n: int, slots: list[tuple], there: tuple = ({}, {})) -> tuple | None:
        """``there`` (item name to document name and back) with the slots' names; None if they disagree."""
        one, two = dict(there[0]), dict(there[1])
        for _, name, mine, other in slots:
            for a, b in zip(map(_name, mine), map(_name, other)) if name else ():
                if a in self.names[n] and (one.setdefault(a, b) != b or two.setdefault(b, a) != a):
                    return None
        return one, two

    def _chain(self, n: int, segments: list[tuple], coverage: float) -> tuple | None:
        """The consistent chain that covers most, as (n_windows, coverage, n_slots, n_changed, first word)."""
        segments.sort(key=lambda s: s[:5])
        size, chains, best = len(self.words[n]), [], None
        for i, (d0, d1, i0, i1, hits, slots) in enumerate(segments):
            values = self._consistent(n, slots)
            top = None if values is None else (i1 - i0, d0, values, (i,))
            for j in range(i - 1, -1, -1) if top else ():
                e0, e1, j0, j1 = segments[j][:4]
                if e0 < d0 - 2 * (size + self.window):
                    break
                if chains[j] is None or j0 > i0 or j1 >= i1 or e1 >= d1 or abs((d0 - i0) - (e1 - j1)) > self.window:
                    continue
                cover = chains[j][0] + i1 - max(i0, j1)
                if cover > top[0]:
                    both = self._consistent(n, slots, chains[j][2])
                    if both:
                        top = (cover, chains[j][1], both, (*chains[j][3], i))
            chains.append(top)
            if top and top[0] >= coverage * size and (best is None or top[0] > best[0]):
                best = top
        if best is None:
            return None
        slots = {s[0]: s for i in best[3] for s in segments[i][5]}
        n_slots, changed = self._changes(n, slots.values())
        return sum(segments[i][4] for i in best[3]), best[0] / size, n_slots, changed, best[1]

    def _changes(self, n: int, slots) -> tuple[int, int]:
        """Slot words of the item, and distinct changes of a value; a
        sentence-initial word that is no name elsewhere is a slot if it changed."""
        count, changed = 0, set()
        for _, name, mine, other in slots:
            a, b = ([*map(_name, side)] if name else _quantity(side) for side in (mine, other))
            count += len(mine) if not name or a != b else sum(x in self.names[n] for x in a)
            pairs = zip(a, b) if len(a) == len(b) else [(tuple(a), tuple(b))]
            changed.update((x, y) for x, y in pairs if x != y)
        return count, len(changed)


def blocks(benchmark: DataFrame, window: int, least: int, id_col: str = "item_id",
           text_col: str = "text") -> Iterator[Index]:
    """The benchmark's indexes, block by block; the driver holds one at a time."""
    part, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).where(
            F.col(text_col).isNotNull()).toLocalIterator():
        part.append((r[0], r[1]))
        size += 4 * len(r[1])
        if size >= BLOCK_BYTES:
            yield Index(part, window, least)
            part, size = [], 0
    if part:
        yield Index(part, window, least)


PAIRS = ("doc_id bigint, item_id bigint, n_windows bigint, coverage double, n_slots bigint, n_changed bigint, "
         "first_word bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, least: int = 4, coverage: float = 0.5,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per contaminated (doc_id, item_id)."""
    C.small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    out = docs.sparkSession.createDataFrame([], PAIRS)
    for index in blocks(benchmark, window, least):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            _CANONICAL.use()
            for b in C.slices(batches):
                rows = [(i, *m) for i, t in zip(b.column("_id").to_pylist(), b.column("_text").to_pylist())
                        for m in shared.value.matches(t, coverage)]
                if rows:
                    kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=[x.split()[0] for x in PAIRS.split(", ")])
        out = out.union(src.mapInArrow(run, PAIRS))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 8, least: int = 4, coverage: float = 0.5,
          text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows."""
    C.small_batches(docs.sparkSession)
    for index in blocks(benchmark, window, least):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            _CANONICAL.use()
            for b in C.slices(batches):
                yield b.filter(pa.array([not shared.value.matches(t, coverage)
                                         for t in b.column(text_col).to_pylist()], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
