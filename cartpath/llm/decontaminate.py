"""Benchmark passages in documents, also with numbers, names and units exchanged.

Items and documents are brought into templates: a number, a name (a run of capitalised words inside a sentence,
in a form of its own also at the start of one)
and a unit after a number become typed placeholders. Windows of a template meet in a hash join. Where
they meet, the values in the placeholders are compared: the item's values must map one to one to the
document's over all windows of one copy, so a re-parameterised question counts and a chance likeness
of templates does not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.llm import words
from cartpath.llm.common import body, rows_of

# Words that stand for numbers, and units that may follow a number.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = "percent dollar dollars euro euros cent cents km kilometers kilometres miles mile m meter meters metres cm mm feet foot inches inch kg kilograms g grams pounds lb liters litres l ml hours hour minutes minute seconds second days day weeks week months month years year mph kmh".split()
NUMBER, NAME, UNIT = (np.uint64(words.hash_of(f"placeholder_{kind}")) for kind in ("number", "name", "unit"))
_NUMBERS = words.Lookup(np.array([words.hash_of(w) for w in NUMBER_WORDS], np.uint64))
_UNITS = words.Lookup(np.array([words.hash_of(w) for w in UNITS], np.uint64))
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?:\n", np.uint8))
_PORTION = 1 << 16  # bytes of texts that are looked at together


@dataclass
class Form:
    """Hashes of the words with placeholders, what stands in the text for each, and the word each begins at."""

    typed: np.ndarray
    plain: np.ndarray
    place: np.ndarray


def _joined(starts: np.ndarray, ends: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans and first words of runs; ``more`` tells the words that continue the run before."""
    at = np.flatnonzero(~more)
    return starts[at], ends[np.append(at[1:], len(starts)) - 1], at


def _lowered(text: bytes) -> tuple[bytes, bytes]:
    """The text with letters beyond ASCII kept and other such characters blanked, and the same lower-cased, of equal length."""
    plain_text = words.letters_only(text)
    raw = plain_text.encode()
    lowered = plain_text.lower().encode()
    if len(lowered) != len(raw):  # a letter whose lower case is longer: lower only those that keep their size
        lowered = "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in plain_text).encode()
    return raw, lowered


def _all_forms(texts: list[bytes]) -> tuple[list[Form], np.ndarray]:
    """Four forms of several texts in a row: with names left plain, with names inside sentences and with all capitalised
    words as names, and as they are; and the first word of each text. A line break between texts lets nothing go on over it."""
    both = [_lowered(t) for t in texts]
    before = np.frombuffer(b"\n".join(raw for raw, _ in both), np.uint8)
    data = np.frombuffer(b"\n".join(low for _, low in both), np.uint8)
    starts, ends = words.spans(data)
    begins = np.cumsum([0] + [len(raw) + 1 for raw, _ in both[:-1]])
    firsts = np.searchsorted(starts, begins)
    if not len(starts):
        return [], firsts
    # Digits with single dots or commas between them are one number.
    digits = words.only_digits(data, starts, ends)
    more = np.zeros(len(starts), bool)
    between = data[np.minimum(ends[:-1], len(data) - 1)]
    more[1:] = digits[1:] & digits[:-1] & (starts[1:] - ends[:-1] == 1) & ((between == ord(".")) | (between == ord(",")))
    starts, ends, place = _joined(starts, ends, more)
    running = words.sums(data)
    plain = words.hashes_of(running, starts, ends)
    number = digits[place] | _NUMBERS.holds(plain)
    unit = _UNITS.holds(plain)
    unit[1:] &= number[:-1]
    opening = np.searchsorted(starts, begins)
    unit[opening[opening < len(unit)]] = False
    first = before[starts]
    two = before[np.minimum(starts + 1, len(before) - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (two >= 0x80) & (two <= 0x9E) & (two != 0x97))
    stops = np.zeros(len(before) + 1, np.int64)
    np.cumsum(_STOP[before], out=stops[1:])
    inside = np.zeros(len(plain), bool)
    inside[1:] = stops[starts[1:]] == stops[ends[:-1]]
    named_plain = np.where(number, NUMBER, np.where(unit, UNIT, plain))
    out = [Form(named_plain, plain, place)]
    for may in (inside, np.ones(len(plain), bool)):
        name = capital & may & ~number & ~unit
        # Capitalised words with a blank between them are one name.
        run = np.zeros(len(plain), bool)
        run[1:] = name[1:] & name[:-1] & (starts[1:] - ends[:-1] == 1) & (data[np.minimum(ends[:-1], len(data) - 1)] == 32)
        whole = _joined(starts, ends, run)
        out.append(Form(np.where(name, NAME, named_plain)[whole[2]], words.hashes_of(running, *whole[:2]), place[whole[2]]))
    return [*out, Form(plain, plain, place)], firsts


def forms(text: bytes) -> list[Form]:
    """The forms of one text, without repeats."""
    out: list[Form] = []
    for form in _all_forms([text])[0]:
        if not any(np.array_equal(form.typed, f.typed) for f in out):
            out.append(form)
    return out


def _portions(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``_PORTION`` bytes, a longer text by itself."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > _PORTION:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _shown_windows(texts: list[bytes], sizes: tuple[int, ...], may: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The windows that ``may`` be an item's, once each: hash, number of the text, first word there, and a row of plain words."""
    found: dict[int, list[np.ndarray]] = {}
    all_forms, firsts = _all_forms(texts)
    for form in all_forms:
        for width, own in words.windows_of_sizes(form.typed, sizes):
            at = np.flatnonzero(may[(own & np.uint64(bits - 1)).astype(np.int64)])
            # The last text that begins at the word or before; texts without words begin where the next one does.
            owner = np.searchsorted(firsts, form.place[at], "right") - 1
            whole = owner == np.searchsorted(firsts, form.place[at + width - 1], "right") - 1
            at, owner = at[whole], owner[whole]
            if len(at):
                shown = form.plain[at[:, None] + np.arange(width)]
                start = form.place[at] - firsts[owner]
                found.setdefault(width, []).append(np.column_stack([own[at], owner.astype(np.uint64), start.astype(np.uint64), shown]))
    for parts in found.values():  # forms share most windows
        rows = np.ascontiguousarray(np.concatenate(parts))
        _, once = np.unique(rows.view(f"V{rows.shape[1] * 8}").reshape(-1), return_index=True)
        rows = rows[once].view(np.int64)
        yield rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3:]


def item_windows(item: bytes, size: int) -> list[tuple[int, int, int, int, np.ndarray, np.ndarray]]:
    """(window hash, form, its number, place, template, plain words) of an item; with fewer words than ``size`` it is one window."""
    out = []
    for n, form in enumerate(forms(item)):
        width = min(size, len(form.typed))
        hashes = words.windows(form.typed, size)
        out += [(int(h), n, k, int(form.place[k]), form.typed[k : k + width], form.plain[k : k + width]) for k, h in enumerate(hashes)]
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = 8, least_share: float = 0.8, least_words: int = 5, least_run: int = 13, filter_bits: int = 22
) -> DataFrame:
    """Pairs of a document and an item it contains: doc_id, item_id, share, n_windows, reparameterised.

    ``share`` is the part of the item's windows found in one copy; pairs of at least ``least_share``, or with
    ``least_run`` words in a row, are returned if the slot values of that copy are consistent.
    ``reparameterised`` tells that some slot has another value than in the item. Templates of fewer than
    ``least_words`` words but for placeholders are too general; such items are found where they are copied
    word by word, from three words on. Null and empty texts contain
    nothing; a null doc_id or item_id takes no part; rows with one doc_id are one document.

    A table of ``2 ** filter_bits`` bits, whatever the size of the benchmark, tells tasks which windows
    can be an item's; it never misses one, and what it lets pass is decided by the hash join.
    """

    def items(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts):
            out = []
            for item_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                found = item_windows(text, size)
                special = [w for w in found if int(np.sum(~np.isin(w[4], (NUMBER, NAME, UNIT)))) >= min(least_words, len(w[4]))]
                special = [w for w in special if len(w[4]) >= 3]
                # Windows of no placeholder match word by word; they are needed where a template is too general.
                exact = {w[1] for w in found if np.array_equal(w[4], w[5])}
                exact = {n for n in exact if all(np.array_equal(w[4], w[5]) for w in found if w[1] == n)} - {0}
                if sum(w[1] == 0 for w in special) == sum(w[1] == 0 for w in found):
                    special = [w for w in special if w[1] not in exact]
                found = special
                # They count for the share only: a passage of equal words does not outweigh other values in the same copy.
                # The share is that of the windows of one form; a copy with other names shows only those with names replaced.
                totals = Counter(w[1] for w in found)
                for h, n, nth, k, form, plain in found:
                    out.append((h, item_id, n, None if n in exact else nth, k, len(form), totals[n], form.view(np.int64), plain.view(np.int64)))
            columns = list(zip(*out, strict=True)) or [[]] * 9
            kinds = [pa.uint64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            arrays[0] = arrays[0].view(pa.int64())
            yield pa.RecordBatch.from_arrays(arrays, names=["window", "item_id", "form_no", "nth", "place", "width", "total", "form", "item_words"])

    named = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), body().alias("text"))
    wanted = named.mapInArrow(items, "window long, item_id long, form_no int, nth int, place int, width int, total int, form array<long>, item_words array<long>")
    # What reaches the driver is bounded: the set bits of the filter, and at most ``size`` widths.
    bits = 1 << filter_bits
    slots = wanted.select(F.pmod("window", F.lit(bits)).cast("int").alias("bit")).distinct()
    packed = slots.groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)).alias("bits"))
    mask = np.zeros(bits // 64, np.int64)
    for at, value in packed.toLocalIterator():
        mask[at] = value
    lookup = docs.sparkSession.sparkContext.broadcast(np.unpackbits(mask.view(np.uint8), bitorder="little").tobytes())
    sizes = tuple(sorted(r.width for r in wanted.select("width").distinct().collect()))

    def candidates(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.frombuffer(lookup.value, np.bool_)
        for rows in rows_of(parts):
            ids, texts = rows.column(0).to_numpy(), rows.column(1).to_pylist()
            for begin, end in _portions(texts):
                for hashes, owners, starts, shown in _shown_windows(texts[begin:end], sizes, may, bits):
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(shown) + 1, dtype=np.int32) * shown.shape[1]), pa.array(shown.reshape(-1)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes), pa.array(ids[begin:end][owners]), pa.array(starts), lists], names=["window", "doc_id", "start", "doc_words"]
                    )

    source = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), body().alias("text"))
    found = source.mapInArrow(candidates, "window long, doc_id long, start long, doc_words array<long>").distinct()
    met = found.join(wanted, "window")

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.array([NUMBER, NAME, UNIT], np.uint64).view(np.int64)
        for rows in rows_of(parts, 8192):
            form, item, doc = (rows.column(c) for c in ("form", "item_words", "doc_words"))
            rows = rows.filter(pc.equal(pc.list_value_length(form), pc.list_value_length(doc)))
            form, item, doc = (rows.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("form", "item_words", "doc_words"))
            slots = np.isin(form, marks)
            owner = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows.column("form")).to_numpy(zero_copy_only=False))
            kept = np.bincount(owner[(form != doc) & ~slots], minlength=rows.num_rows) == 0  # not just equal hashes
            shown = slots & kept[owner]
            rows = rows.filter(pa.array(kept))
            ends = np.append(0, np.cumsum(np.bincount(owner[shown], minlength=len(kept))[kept])).astype(np.int32)
            at = pc.subtract(rows.column("start"), rows.column("place").cast(pa.int64()))
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values[shown])) for values in (item, doc)]
            named = [rows.column(c) for c in ("doc_id", "item_id", "form_no", "nth")]
            yield pa.RecordBatch.from_arrays(
                [*named, at, rows.column("place"), rows.column("total"), *lists],
                names=["doc_id", "item_id", "form_no", "nth", "at", "place", "total", "item_slots", "doc_slots"],
            )

    schema = "doc_id long, item_id long, form_no int, nth int, at long, place int, total int, item_slots array<long>, doc_slots array<long>"
    windows = met.select("doc_id", "item_id", "form_no", "nth", "start", "place", "total", "form", "item_words", "doc_words").mapInArrow(judge, schema)
    # A document may hold an item several times with several values, so each place where it may lie is judged by
    # itself: the exact one, neighbourhoods for copies with words put in or left out, and the document as a whole.
    span = 2 * (F.col("total") + size)
    near = [F.floor((F.col("at") + shift * (F.col("total") + size)) / span).cast("long") for shift in (0, 1)]
    regions = [("exact", F.col("at")), ("even", near[0]), ("odd", near[1]), ("all", F.lit(0).cast("long"))]
    region = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), where.alias("where")) for kind, where in regions]))
    # Forms are judged one by one, and together for a copy that shows some names as they are and some replaced.
    windows = windows.withColumn("form_no", F.explode(F.array("form_no", F.lit(-1))))
    places = windows.withColumn("region", region).groupBy("doc_id", "item_id", "form_no", "region").agg(
        F.countDistinct("place").alias("n_windows"),
        F.max("total").alias("total"),
        F.when(F.col("form_no") >= 0, F.array_sort(F.collect_set("nth"))).alias("nths"),
        F.collect_set(F.struct("place", "item_slots", "doc_slots")).alias("slots"),
    )
    shares = places.withColumn("share", F.least(F.lit(1.0), F.col("n_windows") / F.col("total")))
    # Windows in a row that make a passage of ``least_run`` words: one as far on as many windows later.
    steps = least_run - size
    in_row = F.expr(f"exists(transform(nths, (n, i) -> coalesce(n - get(nths, i - {steps}) = {steps}, false)), x -> x)") if steps >= 0 else F.lit(False)
    shares = shares.where((F.col("share") >= least_share) | F.coalesce((F.col("region.kind") == "exact") & in_row, F.lit(False)))
    consistent, changed = _consistent("slots")
    judged = shares.where(consistent).withColumn("changed", changed)
    # Of several copies the fullest is told, and of these a verbatim one.
    best = F.max(F.struct("share", "n_windows", (~F.col("changed")).alias("verbatim"))).alias("best")
    kept = judged.groupBy("doc_id", "item_id").agg(best)
    return kept.select("doc_id", "item_id", "best.share", "best.n_windows", (~F.col("best.verbatim")).alias("reparameterised"))


def _consistent(slots: str) -> tuple[Column, Column]:
    """Whether the item's values map one to one to values of the document, or stand there themselves; and whether these do not."""
    pair = "transform(arrays_zip(s.item_slots, s.doc_slots), p -> concat(p.item_slots, ':', p.doc_slots))"
    pairs = F.expr(f"size(array_distinct(flatten(transform({slots}, s -> {pair}))))")
    items = F.expr(f"size(array_distinct(flatten(transform({slots}, s -> s.item_slots))))")
    values = F.expr(f"size(array_distinct(flatten(transform({slots}, s -> s.doc_slots))))")
    same = "transform(filter(arrays_zip(s.item_slots, s.doc_slots), p -> p.item_slots = p.doc_slots), p -> p.item_slots)"
    verbatim = items == F.expr(f"size(array_distinct(flatten(transform({slots}, s -> {same}))))")
    return verbatim | ((pairs == items) & (pairs == values)), ~verbatim
