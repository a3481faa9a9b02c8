"""Benchmark decontamination by templates, in DataFrame functions only.

Texts become templates: numbers, names (capitalised words inside a sentence)
and units after numbers give way to typed placeholders, everything else is a
lower-case word. Windows of a template's words are hash-joined with those of
the benchmark, so a question with other numbers, names or units is found too.

Windows of documents are first held against a Bloom filter of the benchmark's
windows, whose size is fixed; the few that pass are joined by hash, so the
corpus is not shuffled. Each matched window then gives the pairs of what stood
in the benchmark's slots and in the document's. Within a document and an item
a slot value must always stand for the same value and the other way round: the
most frequent pairing holds, and windows against it do not count. A document
is contaminated by an item if the windows left cover enough of the item.

Windows with fewer than three plain words say nothing and are not used, whatever
the item. Items of fewer words than a window are windows of their own length. An
item without any such window, like "42", "Yes" or "In 1990", contaminates only
documents that are, as a whole or in one line, the same words and numbers, case
and punctuation aside; it counts as one matched window of one. An item of three
or four plain words is one window, so any document with them in a row has it.
Texts without words match nothing, nor do null texts.
Rows with the same id are one document, null ids included. Results are empty
if either table is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import pin, short_batches

#: Words in a window, and words in it that must not be placeholders.
WIDTH, PLAIN = 5, 3
#: Share of an item's windows that a contaminated document has.
COVERAGE = 0.3
#: Windows that must match at least, or all if the item has fewer.
LEAST = 5
#: Bits of the Bloom filter, by which each window sets three: so many a window, within the bounds.
#: The upper one (2 MB) has a million windows at one in 200 wrongly let through; beyond, more are let through to the join.
BITS_A_WINDOW, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 24

NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
_LETTER = r"[\p{L}\p{M}]"

# Words for numbers, and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg t oz lb lbs gram grams kilogram kilograms ounce ounces pound pounds ton "
    "tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years kmh mph hz khz mhz ghz w kw mw v kv a ma j kj kcal cal pa "
    "kpa bar k c f degree degrees percent usd eur gbp dollar dollars euro euros cent cents"
).split()

# No repeated groups: on long texts Java would match them by recursion until its stack is full.
_DIGITS = r"[0-9](?:[0-9.,:/]*[0-9])?"


def _spelled() -> str:
    """Number words by their first letter, in either case, so that most places fail at one look."""
    letters = dict.fromkeys(word[0] for word in NUMBER_WORDS)
    groups = [f"[{c}{c.upper()}](?:{'|'.join(w[1:] for w in NUMBER_WORDS if w[0] == c)})" for c in letters]
    either = "".join(letters) + "".join(letters).upper()
    return rf"(?=[{either}])(?<!{_LETTER})(?:{'|'.join(groups)})(?!{_LETTER})"


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{NUMBER}-{UNIT}]", " ")


def template(text: Column) -> Column:
    """The words of a text's template; placeholders are single marks."""
    numbers = F.regexp_replace(_plain(text), _DIGITS, f" {NUMBER} ")
    words = F.regexp_replace(numbers, _spelled(), NUMBER)
    units = F.regexp_replace(words, rf"(?i){NUMBER}\s+(?:{'|'.join(UNITS)})(?!{_LETTER})", f"{NUMBER} {UNIT}")
    # A capital letter is looked for first: looking behind at every place would be slow.
    names = F.regexp_replace(units, rf"(?=\p{{Lu}})(?<=[^.!?:\s][\"')\]]{{0,2}}\s{{1,3}}){_LETTER}+", NAME)
    return F.array_remove(F.split(F.lower(names), rf"[^\p{{L}}\p{{M}}{NUMBER}-{UNIT}]+"), "")


def values(text: Column) -> Column:
    """What stands in the text for each word of its template."""
    return F.transform(F.regexp_extract_all(_plain(text), F.lit(rf"({_DIGITS}|{_LETTER}+)")), F.lower)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; inside a lambda Spark would compute it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(words: Column, width: int) -> Column:
    """Hashes of all windows of a template, in order."""
    count = F.size(words) - width + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def _items(benchmark: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """One row per window of an item: item_id, width, windows (of the item), at, hash, words and values.

    And one per item without windows: item_id, hash and values of the whole, and its slots.
    """
    text = F.col(f"`{text_column}`")
    items = benchmark.select(F.col(f"`{id_column}`").cast("long").alias("item_id"), template(text).alias("w"), values(text).alias("v"))
    items = items.filter(F.size("w") > 0).withColumn("width", F.least(F.lit(WIDTH), F.size("w")))
    of_item = Window.partitionBy("item_id")

    def plain(words: Column) -> Column:
        return F.size(F.filter(words, lambda w: ~_is_slot(w)))

    starts = F.sequence(F.lit(1), F.size("w") - F.col("width") + 1)
    most = F.array_max(F.transform(starts, lambda i: plain(F.slice("w", i, F.col("width")))))
    items = items.withColumn("most", F.max(most).over(of_item))
    slots = F.filter(F.arrays_zip(F.col("w").alias("kind"), F.col("v").alias("value")), lambda s: _is_slot(s["kind"]))
    short = items.filter(F.col("most") < PLAIN).select(
        "item_id", F.xxhash64("v").alias("hash"), F.col("v").alias("values"), F.size(F.array_distinct(slots)).cast("long").alias("slots")
    ).distinct()
    each = items.filter(F.col("most") >= PLAIN).withColumn("at", F.explode(starts))
    each = each.select("item_id", "width", "at", F.slice("w", F.col("at"), F.col("width")).alias("words"),
                       F.slice("v", F.col("at"), F.col("width")).alias("values")).distinct()
    each = each.filter(plain(F.col("words")) >= PLAIN)
    each = each.withColumn("windows", F.size(F.collect_set("at").over(of_item)))
    return each.select("item_id", "width", "windows", "at", F.xxhash64("words").alias("hash"), "words", "values"), short


def filter_bits(windows: int) -> int:
    """Bits of a filter of so many windows, a power of two."""
    wanted = max(LEAST_BITS, BITS_A_WINDOW * windows)
    return min(MOST_BITS, 1 << (wanted - 1).bit_length())


def _places(hash_: Column, bits: int) -> list[Column]:
    """The three bits of a hash: of its low, middle and high part, which overlap a little in large filters."""
    return [F.shiftrightunsigned(hash_, 20 * k).bitwiseAND(F.lit(bits - 1)) for k in range(3)]


class _Filter:
    """A Bloom filter of the windows' hashes as a constant array of 64-bit words."""

    def __init__(self, windows: DataFrame) -> None:
        self.bits = filter_bits(windows.count())
        bit = windows.select(F.explode(F.array(*_places(F.col("hash"), self.bits))).alias("bit")).distinct()
        words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
        )
        held = {r["word"]: r["bits"] for r in words.collect()}
        text = ",".join(str(held.get(k, 0)) for k in range(self.bits // 64))
        self.words = F.split(F.lit(text), ",").cast("array<bigint>")

    def may_hold(self, hash_: Column) -> Column:
        def bit_is_set(place: Column) -> Column:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
            return F.get(self.words, F.shiftright(place, 6).cast("int")).bitwiseAND(one) != 0

        first, second, third = (bit_is_set(place) for place in _places(hash_, self.bits))
        return first & second & third


def matches(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE, least: int = LEAST,
            id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
            item_text_column: str = "text") -> DataFrame:
    """Pairs of a contaminated document and an item: doc_id, item_id, matched, windows, coverage and slots."""
    windows, short = _items(benchmark, item_column, item_text_column)
    windows, short = pin(windows, "item-windows"), pin(short, "short-items")
    text = F.col(f"`{text_column}`")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"))
    found = docs.sparkSession.createDataFrame([], RESULT)
    if not windows.isEmpty():
        found = _by_windows(rows, windows, coverage, least)
    if not short.isEmpty():
        found = found.unionByName(_by_lines(rows, short))
    return found


def _each(rows: DataFrame, structs: Column) -> DataFrame:
    """The structs of an array, a row each.

    For an inner explode Spark would compute the whole array three times: to see if it is null, if it is empty, and to use it.
    """
    return rows.select(F.explode_outer(structs).alias("s")).filter("s is not null").select("s.*")


def _by_lines(rows: DataFrame, short: DataFrame) -> DataFrame:
    """Documents that are an item of ``short`` as a whole or in one line."""
    bloom = _Filter(short)
    lines = F.concat(F.array("text"), F.split("text", r"\r\n|\r|\n"))
    hashed = F.filter(F.transform(lines, lambda line: F.struct("doc_id", F.xxhash64(values(line)).alias("hash"), line.alias("line"))),
                      lambda s: bloom.may_hold(s["hash"]))
    each = _each(rows, hashed).select("doc_id", "hash", values(F.col("line")).alias("doc_values"))
    hits = each.join(short, "hash").filter(F.col("doc_values") == F.col("values"))
    with short_batches(rows.sparkSession):
        hits = pin(hits.select("doc_id", "item_id", "slots"), "line-hits")
    one = F.lit(1).cast("long")
    return hits.groupBy("doc_id", "item_id").agg(F.max("slots").alias("slots")).select(
        "doc_id", "item_id", one.alias("matched"), one.alias("windows"), F.lit(1.0).alias("coverage"), "slots")


def _by_windows(rows: DataFrame, windows: DataFrame, coverage: float, least: int) -> DataFrame:
    """Documents that hold enough windows of an item."""
    widths = [r.width for r in windows.select("width").distinct().orderBy("width").collect()]
    bloom = _Filter(windows)

    def passing(words: Column) -> Column:
        """Place, hash and words of each window that the filter lets pass."""
        return F.concat(*[
            F.array_compact(F.transform(_hashes(words, width), lambda h, i: F.when(
                bloom.may_hold(h), F.struct((i + 1).alias("place"), h.alias("hash"), F.slice(words, i + 1, width).alias("doc_words")))))
            for width in widths
        ])

    def with_values(found: Column) -> Column:
        """The windows with what stands in the text for their words, which is only looked up if there are any."""
        return F.when(F.size(found) > 0, _once(values(F.col("text")), lambda v: F.transform(found, lambda f: F.struct(
            "doc_id", f["place"].alias("place"), f["hash"].alias("hash"), f["doc_words"].alias("doc_words"),
            F.slice(v, f["place"], F.size(f["doc_words"])).alias("doc_values")))))

    each = _each(rows, _once(_once(template(F.col("text")), passing), with_values))
    hits = each.join(windows, "hash").filter(F.col("doc_words") == F.col("words"))
    slots = F.filter(F.arrays_zip(F.col("words").alias("kind"), F.col("values").alias("item"), F.col("doc_values").alias("doc")),
                     lambda s: _is_slot(s["kind"]))
    with short_batches(rows.sparkSession):
        hits = pin(hits.select("doc_id", "item_id", "windows", "at", "place", slots.alias("slots")), "template-hits")

    pairs = hits.select("doc_id", "item_id", F.explode("slots").alias("s")).select("doc_id", "item_id", "s.kind", "s.item", "s.doc")
    counted = pairs.groupBy("doc_id", "item_id", "kind", "item", "doc").agg(F.count(F.lit(1)).alias("n"))
    ours = Window.partitionBy("doc_id", "item_id", "kind", "item").orderBy(F.desc("n"), "doc")
    theirs = Window.partitionBy("doc_id", "item_id", "kind", "doc").orderBy(F.desc("n"), "item")
    agreed = counted.withColumn("a", F.row_number().over(ours)).withColumn("b", F.row_number().over(theirs)).filter("a = 1 and b = 1")
    agreed = agreed.groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_set(F.struct("kind", "item", "doc"))).alias("agreed"))
    held = hits.alias("h").join(
        agreed.alias("g"), F.col("h.doc_id").eqNullSafe(F.col("g.doc_id")) & F.col("h.item_id").eqNullSafe(F.col("g.item_id")), "left"
    ).select("h.*", F.coalesce("g.agreed", F.array().cast(AGREED)).alias("agreed"))
    consistent = F.forall("slots", lambda s: F.array_contains("agreed", F.struct(s["kind"].alias("kind"), s["item"].alias("item"), s["doc"].alias("doc"))))
    sums = held.filter(consistent).groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("matched"), F.max("windows").cast("long").alias("windows"),
        F.size(F.max("agreed")).cast("long").alias("slots"),
    )
    share = F.col("matched") / F.col("windows")
    enough = (share >= coverage) & (F.col("matched") >= F.least(F.lit(least).cast("long"), F.col("windows")))
    return sums.filter(enough).select("doc_id", "item_id", "matched", "windows", share.alias("coverage"), "slots")


AGREED = "array<struct<kind:string,item:string,doc:string>>"
RESULT = "doc_id long, item_id long, matched long, windows long, coverage double, slots long"


#: Documents that are dropped by a broadcast of their ids; of more, the documents are shuffled.
MOST_BROADCAST = 250_000


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """``docs`` without the documents that any item contaminates."""
    bad = pin(matches(docs, benchmark, **options).select(F.col("doc_id").alias("_bad")).distinct(), "contaminated")
    if bad.count() <= MOST_BROADCAST:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]), "left_anti")
