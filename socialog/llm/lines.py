"""Near-equal lines by an exact set-similarity join, in DataFrame functions alone.

A line is the set of its words. Two lines match if their Jaccard similarity is 4/5
or more. A line is removed if an earlier line (by id, then place) matches it.

Lines with equal sets are one class, so copies cost one row; equal sets are told by two
64-bit hashes of the sorted hashes of their words. The words of a class
are ordered by rarity (exact counts over all lines in ``BUCKETS`` hash buckets, in
logarithmic steps, ties by hash). Two classes that match share one of the first
``n - ceil(4n/5) + 1`` words of the longer and ``n - ceil(8n/9) + 1`` of the shorter (prefix filter); with sizes within 4/5 of each other
(length filter), enough words from the first shared one on (positional filter) and
parities of their words over 128 bits that differ in no more bits than the sets may in
words, they are candidates, whose word sets are then compared, word by word. The join by
shared word applies all of these, so only candidates are shuffled. For the comparison, lines are
fetched by place; a bit set of fixed size keeps most lines that nobody asked for from moving.

A class needs one earlier match. Where a prefix word is in ``HOT`` classes or more, these are first
held against a few of them, in each of ``SHARES`` parts the earliest and the one with most lines (copies that nobody
edited are near all others), by their ``PROBES`` commonest prefix words. Only classes that this leaves without
a match are held against all earlier ones: a group of near copies costs few comparisons a line, not
all its pairs. Where very many lines share rare words and parities and yet don't match,
all their pairs are compared.

All lines of a class whose first line comes after the first line of a matching
class are removed, and of any other class all but the first line.

Defined results: words are what spaces separate, lines what ``\\n`` separates; other
blanks around a line don't count. Blank lines match nothing and stay. NULL text stays NULL, with no line. Rows with
equal id and text are one place: their lines are kept or removed alike. NULL ids
come first. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialog.llm.base import free_name
from socialog.session import scratch, written

BUCKETS = 1 << 19
RANK_BITS = 6
STEPS = 1.6  # ranks for each doubling of a count
BLANKS = " \t\x0b\f\r"
PART, WHOLE = 4, 5  # the least similarity as a fraction
LONG = 64  # words from which the parities of a set take 128 bits, not 64
HOT, SHARES, PROBES = 200, 4, 4  # steer work only
FAST_KEYS = "spark.sql.codegen.aggregate.fastHashMap.capacityBit"  # log2 of the keys in the faster map of an aggregate
BITS = 1 << 21


def _trimmed(line: Column) -> Column:
    """Without blanks at both ends; trimming a right end looks at each character, so it is done only where one is blank."""
    ends = F.lit(False)
    for blank in BLANKS:
        ends = ends | line.endswith(F.lit(blank))
    return F.ltrim(F.when(ends, F.rtrim(line, F.lit(BLANKS))).otherwise(line), F.lit(BLANKS))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(_trimmed(line), " "), "")


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(BUCKETS - 1).cast("int")


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.xxhash64("doc_id", text).alias("_mark"),
        F.col(text).alias("_text"),
    )


def _placed(texts: DataFrame) -> DataFrame:
    return texts.select("_id", "_mark", F.posexplode(F.split("_text", "\n")).alias("_line", "_text"))


def _rank(count: Column) -> Column:
    return F.least(F.floor(F.log2(count) * STEPS), F.lit((1 << RANK_BITS) - 1)).cast("int")


def _rarity(texts: DataFrame) -> Column:
    """Ranks of all hash buckets, an array: in steps of the logarithm of how often the words of each occur."""
    # Blanks at the ends of a line stay with their word here, which changes no more than a rank.
    counts = (
        texts.select(F.explode(F.split(F.replace("_text", F.lit("\n"), F.lit(" ")), " ")).alias("w"))
        .groupBy(_bucket(F.xxhash64("w")).alias("bucket"))
        .count()
    )
    # BUCKETS rows whatever the input, in the end one array.
    runs = (
        texts.sparkSession.range(BUCKETS)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .groupBy(F.shiftright("bucket", 10).alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("bucket", F.coalesce(_rank(F.col("count")), F.lit(0)).alias("rank")))).alias("of"))
        .select("run", F.transform("of", lambda x: x["rank"].cast("tinyint")).alias("ranks"))
    )
    conf = texts.sparkSession.conf
    before = conf.get(FAST_KEYS)
    conf.set(FAST_KEYS, BUCKETS.bit_length())  # all buckets find room there
    try:
        return _one_array(runs, "run", "ranks", "word-ranks")
    finally:
        conf.set(FAST_KEYS, before)


def _one_array(rows: DataFrame, key: str, values: str, label: str) -> Column:
    """The arrays ``values`` of all ``rows`` by ``key`` as one, a scalar subquery.

    As a literal, its text would stand in each description of a plan, which the driver keeps.
    """
    of = F.sort_array(F.collect_list(F.struct(key, values)))
    return written(rows.agg(F.flatten(F.transform(of, lambda x: x[values])).alias(values)), label).scalar()


def _hashes(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    hashes = F.transform(F.split(_trimmed(line), " "), lambda word: F.xxhash64(word))
    return F.array_except(hashes, F.array(F.xxhash64(F.lit(""))))


def _by_rarity(line: Column, ranks: Column, hashes: Column | None = None) -> Column:
    """Distinct words of a line as sorted numbers: rank in the high bits, hash in the low ones.

    ``hashes`` are those of the line where they are a column already: Spark compiles what makes a column,
    but interprets all that stands inside a function with a lambda.
    """
    keep = 63 - RANK_BITS

    def number(hashed: Column) -> Column:
        # Never null, so that the numbers are sorted as an array of plain longs.
        rank = F.coalesce(F.get(ranks, _bucket(hashed)), F.lit(0).cast("tinyint")).cast("long")
        return F.shiftleft(rank, keep).bitwiseOR(F.shiftrightunsigned(hashed, 64 - keep))

    return F.sort_array(F.transform(_hashes(line) if hashes is None else hashes, number))


def _needed(size: Column) -> Column:
    """Least size of a set that matches one of ``size``."""
    return F.floor((size * PART + WHOLE - 1) / WHOLE).cast("int")


def _needed_of_longer(size: Column) -> Column:
    """Least number of words that a set of ``size`` shares with one that matches it and is no smaller."""
    return F.floor((size * 2 * PART + PART + WHOLE - 1) / (PART + WHOLE)).cast("int")


def _odd(numbers: Column, upper: bool = False) -> Column:
    """Whether an odd number of words falls on each of 64 bits; of words on the upper half of 128 bits alone, if ``upper``."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def bit(word: Column) -> Column:
        counts = F.shiftrightunsigned(word, 6).bitwiseAND(one) if upper else one
        return F.call_function("shiftleft", counts, word.bitwiseAND(63).cast("int"))

    return F.aggregate(numbers, none, lambda bits, word: bits.bitwiseXOR(bit(word)))


def classes(texts: DataFrame) -> DataFrame:
    """One row for each word set: its number, first line, lines, size, rarest words and parities.

    ``odd`` is the parities of all words, ``odd2`` of those on the upper half, 0 for a short set.
    """
    sets = (
        _placed(texts)
        .filter(_not_blank(F.col("_text")))
        .withColumn("_hashes", _hashes(F.col("_text")))
        # A lambda may not hold a subquery itself. The size stands beside it, so that Spark doesn't put it one
        # step earlier, with the hashes: there the ranks would become part of each row.
        .withColumns({"_size": F.size("_hashes"), "_ranks": _rarity(texts)})
        .withColumn("_sorted", _by_rarity(F.col("_text"), F.col("_ranks"), F.col("_hashes")))
    )
    return written(
        sets.select(
            F.xxhash64("_sorted").alias("_a"),
            F.xxhash64(F.lit(1), "_sorted").alias("_b"),
            # Lines of a class differ in their place alone, so the least of all columns is the first line with its words.
            F.struct(
                F.struct("_id", "_mark", "_line").alias("first"),
                F.col("_size").alias("size"),
                F.slice("_sorted", 1, F.col("_size") - _needed(F.col("_size")) + 1).alias("rarest"),
                _odd(F.col("_sorted")).alias("odd"),
                F.when(F.col("_size") >= LONG, _odd(F.col("_sorted"), upper=True)).otherwise(F.lit(0).cast("long")).alias("odd2"),
            ).alias("_of"),
        )
        .groupBy("_a", "_b")
        .agg(F.min("_of").alias("_of"), F.count(F.lit(1)).alias("lines"))
        .select(F.monotonically_increasing_id().alias("number"), "lines", "_of.*"),
        "line-classes",
    )


def _prefixes(found: DataFrame, *more: str | Column, shared=_needed) -> DataFrame:
    """The prefix words of each class, of which a match has ``shared``; ``rest`` is how many of its words stand from there on."""
    size = F.col("size")
    prefix = F.slice("rarest", 1, size - shared(size) + 1)
    # Sets of fewer than PART words match equal sets alone.
    return (
        found.filter(size >= PART)
        .select("number", "size", "odd", "odd2", *more, F.posexplode(prefix).alias("rest", "word"))
        .withColumn("rest", size - F.col("rest"))
    )


def _may_match(a: str, b: str) -> Column:
    """Length filter, and parities: a word of only one set changes one bit.

    Two long sets are compared on both halves of 128 bits; otherwise the halves fall together.
    """
    size_a, size_b, odd_a, odd_b, odd2_a, odd2_b = (
        F.col(side.format(name)) for name in ("size", "odd", "odd2") for side in (a, b)
    )
    together = size_a + size_b
    odd, odd2 = odd_a.bitwiseXOR(odd_b), odd2_a.bitwiseXOR(odd2_b)
    both_long = F.least(size_a, size_b) >= LONG
    differ = F.bit_count(odd)
    halves = F.bit_count(odd.bitwiseXOR(odd2)) + F.bit_count(odd2)
    most = together * (WHOLE - PART)
    return (
        (F.least(size_a, size_b) * WHOLE >= F.greatest(size_a, size_b) * PART)
        & (differ * (PART + WHOLE) <= most)
        & (~both_long | (halves * (PART + WHOLE) <= most))
    )


def pivots(found: DataFrame) -> DataFrame:
    """Candidates of which one is the earliest class, by id, or that of most lines, of a part of those with a common prefix word.

    Which words and classes are used steers work only; near copies share most of their words. The
    words used are seldom the first that two classes share, so the positional filter has no place here.
    """
    rank = F.shiftrightunsigned("word", 63 - RANK_BITS)
    prefixes = _prefixes(found, F.col("first._id").alias("id"), "lines", F.size("rarest").alias("prefix"))
    prefixes = prefixes.filter(rank >= _rank(F.lit(HOT)))  # a rarer one is in fewer classes
    names = ("number", "id", "size", "odd", "odd2")
    earliest = F.struct(*[F.min_by(c, "id").alias(f"_{c}") for c in names])
    largest = F.struct(*[F.max_by(c, "lines").alias(f"_{c}") for c in names])
    # Words are counted alone first, so that only those of many classes move more than their number.
    hot = written(prefixes.groupBy("word").count().filter(F.col("count") >= HOT).select("word"), "hot-words")
    prefixes = prefixes.join(hot, "word", "left_semi")
    few = written(
        prefixes.groupBy("word", F.pmod(F.xxhash64("number"), F.lit(SHARES)).alias("share"))
        .agg(earliest.alias("earliest"), largest.alias("largest"))
        .select("word", F.explode(F.array_distinct(F.array("earliest", "largest"))).alias("of"))
        .select("word", "of.*"),
        "line-pivots",
    )
    probes = F.col("size") - F.col("rest") >= F.col("prefix") - PROBES
    met = prefixes.filter(probes).join(few, "word").filter(
        (F.col("_id") <= F.col("id")) & (F.col("number") != F.col("_number")) & _may_match("{}", "_{}")
    )
    return _pairs(met, "number", "_number")


def candidates(found: DataFrame, late: DataFrame) -> DataFrame:
    """Pairs of classes that pass all filters, of which one at least is not among ``late``.

    The filters are part of the join. At the first word they share, two lines that match
    pass the positional one: no shared word stands before it. So few words stand before it in
    the shorter line that a shorter prefix of it will do: ``a`` is the shorter one, of equal ones that of the smaller number.
    """
    marked = found.join(late.withColumn("late", F.lit(True)), "number", "left")
    # One column for both, as these rows are what is shuffled most: ``rest``, negated in a late class.
    rest = F.when(F.col("late"), -F.col("rest")).otherwise(F.col("rest"))
    a = _prefixes(marked, "late", shared=_needed_of_longer).withColumn("rest", rest).drop("late")
    b = _prefixes(marked, "late").withColumn("rest", rest).drop("late")
    a = a.select(*[F.col(c).alias(f"{c}_a") for c in a.columns])
    b = b.select(*[F.col(c).alias(f"{c}_b") for c in b.columns])
    shorter = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("number_a") < F.col("number_b")))
    met = a.join(
        b,
        (F.col("word_a") == F.col("word_b"))
        & shorter
        & (F.least(F.abs("rest_a"), F.abs("rest_b")) * (PART + WHOLE) >= (F.col("size_a") + F.col("size_b")) * PART)
        & (F.greatest("rest_a", "rest_b") > 0)
        & _may_match("{}_a", "{}_b"),
    )
    return _pairs(met, "number_a", "number_b")


def _pairs(met: DataFrame, a: str, b: str) -> DataFrame:
    return met.select(F.least(a, b).alias("number_a"), F.greatest(a, b).alias("number_b")).distinct()


def _asked_for(places: DataFrame, *key: str) -> Column:
    """Whether a row's key may be among those of ``places``: a bit for each hash, BITS in all."""
    bit = F.pmod(F.xxhash64(*key), F.lit(BITS))
    word, mask = F.shiftright(bit, 6), F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    words = (
        places.select(bit.alias("_bit"))
        .groupBy(F.shiftright("_bit", 6).alias("word"))
        .agg(F.bit_or(mask).alias("bits"))  # at most BITS / 64 rows
    )
    held = (
        places.sparkSession.range(BITS // 64)
        .join(words, F.col("id") == F.col("word"), "left")
        .select("id", F.array(F.coalesce("bits", F.lit(0).cast("long"))).alias("bits"))
    )
    found = F.get(_one_array(held, "id", "bits", "places-asked-for"), word.cast("int"))
    return F.getbit(found, F.pmod(bit, F.lit(64)).cast("int")) == 1


def _late(texts: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Numbers of the later class of each of ``pairs`` that match, by their whole word sets."""
    wanted = written(
        pairs.select(F.explode(F.array("number_a", "number_b")).alias("number"))
        .distinct()
        .join(found.select("number", "first", "size"), "number")
        .select("number", "first", "size", "first.*"),
        "line-places",
    )
    sets = written(
        _placed(texts.filter(_asked_for(wanted, "_id", "_mark")))
        .filter(_asked_for(wanted, "_id", "_mark", "_line"))
        .join(wanted, ["_id", "_mark", "_line"])
        .groupBy("number", "first", "size")
        .agg(F.first("_text").alias("text"))
        .select("number", "first", "size", _words(F.col("text")).alias("words")),
        "line-words",
    )
    a = sets.select(*[F.col(c).alias(f"{c}_a") for c in sets.columns])
    b = sets.select(*[F.col(c).alias(f"{c}_b") for c in sets.columns])
    shared = F.size(F.array_intersect("words_a", "words_b"))  # distinct words, as sizes count them
    matches = (
        pairs.join(a, "number_a")
        .join(b, "number_b")
        .filter(shared * (PART + WHOLE) >= (F.col("size_a") + F.col("size_b")) * PART)
    )
    later = F.when(F.col("first_a") < F.col("first_b"), F.col("number_b")).otherwise(F.col("number_a"))
    return written(matches.select(later.alias("number")).distinct(), "late-lines")


def late_classes(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Numbers of the classes that match one whose first line is earlier.

    One earlier match is enough. Each class is first held against a few with
    its commoner prefix words, which settles large groups of near copies in few
    comparisons, and only classes without a match there against all others.
    """
    first = written(pivots(found), "line-pairs")
    late = _late(texts, found, first)
    rest = candidates(found, late).join(first, ["number_a", "number_b"], "left_anti")
    return late.union(_late(texts, found, written(rest, "line-pairs"))).distinct()


def kept_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_id, _mark, _kept): places of the non-blank lines that stay, per document with any."""
    texts = _texts(docs, text)
    with scratch(docs.sparkSession):
        found = classes(texts)
        late = late_classes(texts, found)
        kept = (
            found.join(late, "number", "left_anti")
            .select("first.*")
            .groupBy("_id", "_mark")
            .agg(F.collect_list("_line").alias("_kept"))
        )
        return written(kept, "kept-lines", keep=True)


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_lines (non-blank), n_removed and the places of the kept lines of every row."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.xxhash64("doc_id", text).alias("_mark"),
        F.coalesce(F.size(F.filter(F.split(F.col(text), "\n"), _not_blank)), F.lit(0))
        .cast("long")
        .alias("n_lines"),
    )
    none = F.array().cast("array<int>")
    kept = F.sort_array(F.coalesce("_kept", none))
    return rows.join(kept_lines(docs, text), ["_id", "_mark"], "left").select(
        "doc_id",
        "n_lines",
        (F.col("n_lines") - F.size(kept)).alias("n_removed"),
        kept.alias("kept_lines"),
    )


def _not_blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) != ""


def without_similar_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with the lines removed that match an earlier one; other columns as they are."""
    names = docs.columns
    kept = kept_lines(docs.select("doc_id", text), text)
    hold = free_name(docs, "_row")
    rows = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.xxhash64(docs["doc_id"], docs[text]).alias("_mark"),
        F.struct(*[docs[c] for c in names]).alias(hold),
    ).join(kept, ["_id", "_mark"], "left")
    # Lines and kept places are sorted together: a kept place stands before its line.
    line = F.transform(
        F.split(F.col(f"{hold}.`{text}`"), "\n"),
        lambda words, i: F.struct(i.alias("at"), F.lit(1).alias("kind"), words.alias("words")),
    )
    place = F.transform(
        F.coalesce("_kept", F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("at"), F.lit(0).alias("kind"), F.lit("").alias("words")),
    )
    rows = rows.withColumn("_both", F.sort_array(F.concat(line, place)))

    def stays(entry: Column, i: Column) -> Column:
        before = F.get(F.col("_both"), i - 1)
        marked = F.coalesce((before["at"] == entry["at"]) & (before["kind"] == 0), F.lit(False))
        return (entry["kind"] == 1) & (marked | ~_not_blank(entry["words"]))

    new = F.array_join(F.transform(F.filter("_both", stays), lambda e: e["words"]), "\n")
    return rows.select(*[(new if c == text else F.col(f"{hold}.`{c}`")).alias(c) for c in names])
