"""Benchmark passages in documents, found by templates with typed slots."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, free_name, map_arrow, materialise, with_row

#: Words that count as units when they follow a number.
UNITS = frozenset("""mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
mg g kg t oz lb lbs gram grams kilogram kilograms pound pounds ton tons ml cl l liter liters litre litres gallon gallons
s sec second seconds min minute minutes h hour hours day days week weeks month months year years percent degrees degree
dollar dollars euro euros cent cents usd eur gbp mph kmh kph hz khz mhz ghz v w kw kwh j kj cal kcal c f k""".split())
WORD, NUMBER, UNIT, NAME, MEASURE = range(5)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"\d[\d.,:/^-]*%?$")
_MEASURE = re.compile(r"\d[\d.,]*([^\W\d_]+)$")
_ENDS = (".", "!", "?", ":")
_BIT_MASK = (1 << 22) - 1
_FACTOR = 0x9E3779B97F4A7C15
_IS_UNIT, _ENDED = 1 << 1, 1 << 3
#: Kind by the marks of a word (number, unit, title, ends a sentence, measure); names at the start of a sentence are undone later.
_KINDS = np.array([MEASURE if m & 16 else NUMBER if m & 1 else NAME if m & 4 else WORD for m in range(32)], dtype=np.uint8)


class Forms:
    """Memo of what each word is by itself; emptied when it has grown large."""

    def __init__(self, limit: int = 300_000) -> None:
        self.limit, self.number = limit, {}
        self.bare: list[str] = []
        self.codes, self.flags = np.zeros(1 << 12, dtype=np.uint64), np.zeros(1 << 12, dtype=np.uint8)

    def add(self, word: str) -> int:
        at = self.number[word] = len(self.bare)
        if at == len(self.codes):
            self.codes, self.flags = np.resize(self.codes, 2 * at), np.resize(self.flags, 2 * at)
        bare = _EDGES.sub("", word)
        low, measure = bare.casefold(), _MEASURE.match(bare)
        marks = (_NUMBER.match(bare), low in UNITS, len(bare) > 1 and bare[0].isupper() and bare[1:].islower(), word.endswith(_ENDS),
                 measure and measure[1].lower() in UNITS)
        self.flags[at] = sum(1 << k for k, m in enumerate(marks) if m)
        self.codes[at] = xxhash.xxh64_intdigest(low) if bare else 0
        self.bare.append(bare)
        return at

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes with all slots, with all but names and with none, kinds and numbers of the words of a text.

        Words of mere punctuation are left out.
        """
        if len(self.number) > self.limit:
            self.__init__(self.limit)
        for w in filterfalse(self.number.__contains__, set(words)):
            self.add(w)
        at = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        codes, flags = self.codes[at], self.flags[at]
        kinds = _KINDS[flags]
        kinds[1:][(kinds[1:] == NAME) & (flags[:-1] & _ENDED != 0)] = WORD
        kinds[:1][kinds[:1] == NAME] = WORD
        if not codes.all():
            kept = np.flatnonzero(codes)
            codes, kinds, flags, at = codes[kept], kinds[kept], flags[kept], at[kept]
        literal, plain = codes, codes
        if (kinds != WORD).any():
            kinds[1:][(kinds[:-1] == NUMBER) & (flags[1:] & _IS_UNIT != 0)] = UNIT
            slot, name = kinds != WORD, kinds == NAME
            codes = np.where(slot, kinds, literal)
            plain = np.where(slot & ~name, kinds, literal) if name.any() else codes
        return codes, plain, literal, kinds, at


def template_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every window of ``width`` tokens, put together from windows of powers of two."""
    n = len(codes) - width + 1
    if n < 1:
        return codes[:0]
    value, done, part, size = np.zeros(n, dtype=np.uint64), 0, codes, 1
    while True:
        if width & size:
            value = value * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[done:done + n]
            done += size
        if done == width:
            break
        part = part[:-size] * np.uint64(pow(_FACTOR, size, 1 << 64)) + part[size:]
        size *= 2
    return (value ^ value >> np.uint64(31)) * np.uint64(_FACTOR)


def slots(kinds: np.ndarray, bare: list[str], at: np.ndarray, start: int, width: int) -> list[str]:
    """Type and value of the slots of a window, in order."""
    return [f"{kinds[k]}{bare[at[k]].casefold()}" for k in range(start, start + width) if kinds[k] != WORD]


def pattern(values: Iterable[str]) -> str:
    """Which slots are equal: each value's place among the distinct ones."""
    place: dict[str, int] = {}
    return ",".join(str(place.setdefault(v, len(place))) for v in values)


def template_windows(rows: DataFrame, widths: list[int], allowed: np.ndarray | None = None, whole_below: int = 0, least: int = 0) -> DataFrame:
    """Windows of ``row, text``: ``row, pos, width, form, hash, slots, pattern, tokens``.

    A window has up to three forms: 0 with all slots, 1 with names read as words, 2 with no slots; forms equal to one
    before are left out, as are the first two where over half of the window is slots or it has fewer than ``least`` tokens.
    With ``allowed`` (a bit map) only windows whose hash is set there. With ``whole_below`` texts of fewer tokens give one
    window of all their tokens.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = Forms()
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                *read, kinds, at = forms.of((text.as_py() or "").split())
                n = len(kinds)
                kinds_of = (kinds, np.where(kinds == NAME, WORD, kinds), np.zeros_like(kinds))
                for width in (widths if n >= whole_below else [n] if n else []):
                    for form in (0, 1, 2) if width >= least else (2,):
                        if form and width >= least and read[form] is read[form - 1]:
                            continue  # nothing to read in another way
                        hashes = template_hashes(read[form], width)
                        starts = np.arange(len(hashes)) if allowed is None else np.flatnonzero(allowed[(hashes & np.uint64(_BIT_MASK)).astype(np.int64)])
                        for start in starts.tolist():
                            part = slice(start, start + width)
                            if form and width >= least and (kinds_of[form][part] == kinds_of[form - 1][part]).all() and (
                                    2 * np.count_nonzero(kinds_of[form - 1][part]) <= width):
                                continue
                            values = slots(kinds_of[form], forms.bare, at, start, width)
                            if 2 * len(values) <= width:  # at least half of it is words
                                out.append((row, start, width, form, int(hashes[start].astype(np.int64)), values, pattern(values), n))
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)

    schema = "row long, pos int, width int, form int, hash long, slots array<string>, pattern string, tokens int"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.int32()]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in schema.split(", ")])

    return map_arrow(rows, cut, schema)


def bit_map(windows: DataFrame) -> np.ndarray:
    """Four megabytes, whatever the number of windows, that tell which ends of hashes occur; it only thins out what is joined."""
    bit = F.col("hash").bitwiseAND(F.lit(_BIT_MASK))
    words = windows.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((hash & {_BIT_MASK}) & 63 AS int))")).alias("bits"))
    made = np.zeros((_BIT_MASK + 1) // 64, dtype="<u8")
    for word, bits in words.collect():
        made[word] = bits % (1 << 64)
    return np.unpackbits(made.view(np.uint8), bitorder="little").view(bool)


def judge(hits: list[dict]) -> tuple[int, int | None]:
    """Tokens of the longest run that meets its need (0 if none does) and the smallest item in such runs.

    Runs of windows that are equal to the benchmark's word by word count by themselves, too, as no slot can break those.
    """
    found = [runs(hits), runs([h for h in hits if not h["slots"]])]
    return max(best for best, _ in found), min((item for _, item in found if item is not None), default=None)


def runs(hits: list[dict], strict: bool = True) -> tuple[int, int | None]:
    """``judge`` for these windows together; without ``strict`` slots may be filled in any way.

    A run is a row of matched windows without a gap. Within it, windows that follow the same item in step must fill the
    item's slots one to one: equal values by equal values, others by others; where that breaks, a new run begins. Each form
    of the windows is followed by itself.
    """
    best, item = 0, None
    start = stop = need = low = 0
    states: dict[int, tuple] = {}
    for h in sorted(hits, key=lambda h: (h["pos"], h["width"], h["form"])):
        here = (h["item_id"], h["item_pos"] - h["pos"])
        pairs = list(zip(h["item_slots"], h["slots"]))
        step, there, back = states.get(h["form"], (None, {}, {}))
        if here != step:
            there, back = {}, {}
        fits = not strict or all(there.get(a, b) == b and back.get(b, a) == a for a, b in pairs)
        if h["pos"] > stop or not fits or not stop:
            start, stop, need, low, there, back = h["pos"], 0, h["need"], h["item_id"], {}, {}
            states.clear()
        there |= dict(pairs)
        back |= {b: a for a, b in pairs}
        states[h["form"]] = here, there, back
        stop = max(stop, h["pos"] + h["width"])
        need, low = min(need, h["need"]), min(low, h["item_id"])
        if stop - start >= need:
            best, item = max(best, stop - start), low if item is None else min(item, low)
    return best, item


def per_text(hits: DataFrame, judged: Callable, schema: str, *keys: str) -> DataFrame:
    """``keys`` and the columns that ``judged`` makes of the column ``hit`` of each group."""
    fields = [f.split() for f in schema.split(", ")]

    def verdicts(found: pa.Array) -> pa.Array:
        rows = [judged(h) for h in found.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.bool_() if kind == "boolean" else pa.int64())
                                           for k, (_, kind) in enumerate(fields)], [name for name, _ in fields])

    grouped = hits.groupBy(*keys).agg(F.collect_list("hit").alias("hits"))
    return grouped.select(*keys, apply_arrow(hits, verdicts, schema, "hits").alias("v")).select(*keys, "v.*")


HIT = ("pos", "width", "form", "slots", "item_id", "item_pos", "item_slots", "need")


def second_look(found: DataFrame, hits: DataFrame, texts: DataFrame, items: DataFrame, width: int, min_run: int, least: int) -> DataFrame:
    """``found``, with the texts whose run broke at a slot judged again by other items of the same templates.

    Windows as wide as a run (or a whole shorter item) name them: a text that holds a run of an item shares such a window with
    it, slot for slot, and one item a template and pattern of wide windows is enough. ``hits`` (windows of the texts) are then followed for each
    of these items by itself, so a text costs its own windows times the few items it shares wide ones with.
    """
    broken = found.where("broken").select("row")
    if broken.isEmpty():
        return found
    wide = max(width, min_run)
    known = template_windows(items, [wide], whole_below=wide, least=least)
    known = materialise(known.groupBy("hash", "width", "pattern").agg(F.min("row").alias("item_id")), "templates")
    widths = sorted(w for (w,) in known.select("width").distinct().collect())  # at most ``wide`` different ones
    shared = template_windows(texts.join(broken, "row", "left_semi"), widths, allowed=bit_map(known), least=least)
    shared = materialise(shared.join(known, ["hash", "width", "pattern"]).select("row", "item_id").distinct(), "shared")
    own = items.join(shared.select(F.col("item_id").alias("row")).distinct(), "row", "left_semi")
    own = template_windows(own, [width], whole_below=width, least=least).select(
        F.col("row").alias("item_id"), "hash", "width", "pattern", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"),
        F.least(F.col("tokens"), F.lit(min_run)).alias("need"))
    again = hits.join(broken, "row", "left_semi").join(shared.join(own, "item_id"), ["row", "hash", "width", "pattern"])
    again = per_text(again.select("row", "item_id", F.struct(*HIT).alias("hit")), judge, "tokens long, item long", "row", "item_id")
    again = again.groupBy("row").agg(F.max("tokens").alias("tokens"), F.min("item").alias("item"))
    return found.join(again, "row", "left").select("row", F.greatest("matched_tokens", "tokens").alias("matched_tokens"), F.least("item_id", "item").alias("item_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = 8, min_run: int = 13, min_item: int = 5) -> DataFrame:
    """``docs`` with ``contaminated`` (boolean), ``matched_tokens`` and ``item_id``, the smallest item found (replaced if there).

    Texts become tokens: words without the punctuation around them, in lower case; numbers, units behind numbers and
    names (capitalised inside a sentence) become typed slots. Windows of ``width`` tokens, at least half of them words, are
    looked up by a hash of the template in those of the benchmark, and must repeat slot values where the item does. Each
    window is also looked up with its names read as words, so that letter case and the word before do not matter, and word by
    word without slots, whatever its share of slots: an exact copy in any letter case is always found. A
    document is contaminated by a run of windows over ``min_run`` tokens (or the length of a shorter item) whose slots can be
    filled consistently. Items of under ``width`` tokens are looked up as a whole; those of under ``min_item`` tokens
    word by word only. Everyday text holds an item like "yes", so leave out such items before if its documents shall stay. Null and empty documents are clean, repeated rows return
    as often as they occur, empty tables on either side give clean documents or none.

    The benchmark's hashes reach the tasks as a bit map of fixed size, so that few windows leave them; the exact join
    follows on a key that uneven data cannot overload, as each template has one row on the benchmark's side for each
    pattern of its slots, whatever the number of items that share it. Documents whose run breaks at a slot of that one item
    are looked up again in windows as wide as a run, which name the other items to follow.
    """
    docs, row = with_row(docs, doc_id)
    items = benchmark.select(F.col(item_id).cast("long").alias("row"), F.col(item_text).alias("text")).where("row IS NOT NULL AND text IS NOT NULL")
    known = template_windows(items, [width], whole_below=width, least=min_item)
    known = materialise(known.groupBy("hash", "width", "pattern").agg(
        F.min(F.struct(F.col("row").alias("item_id"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))).alias("item"),
        F.min(F.least(F.col("tokens"), F.lit(min_run))).alias("need")).select("hash", "width", "pattern", "item.*", "need"), "templates")
    widths = sorted(w for (w,) in known.select("width").distinct().collect())  # at most ``width`` different ones
    texts = docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(f"`{text}`").alias("text"))
    hits = template_windows(texts, widths, allowed=bit_map(known), least=min_item).drop("tokens")
    hits = materialise(hits.join(known, ["hash", "width", "pattern"]), "hits")

    def judged_with_breaks(found: list[dict]) -> tuple[int, int | None, bool]:
        best, item = judge(found)
        return best, item, runs(found, strict=False)[0] > best

    found = per_text(hits.select("row", F.struct(*HIT).alias("hit")), judged_with_breaks, "matched_tokens long, item_id long, broken boolean", "row")
    judged = second_look(materialise(found, "verdicts"), hits.drop("item_id", "item_pos", "item_slots", "need"), texts, items, width, min_run, min_item)
    kept = [c for c in docs.columns if c.lower() not in ("contaminated", "matched_tokens", "item_id") and (c != row or row == doc_id)]
    key, n, item = (free_name(docs, c) for c in ("hit_row", "hit_tokens", "hit_item"))
    judged = judged.select(F.col("row").alias(key), F.col("matched_tokens").alias(n), F.col("item_id").alias(item))
    joined = docs.join(judged, F.col(f"`{row}`").cast("long") == F.col(key), "left")
    tokens = F.coalesce(F.col(n), F.lit(0).cast("long"))
    return joined.select(*(F.col(f"`{c}`") for c in kept), (tokens > 0).alias("contaminated"), tokens.alias("matched_tokens"),
                         F.col(item).alias("item_id"))
