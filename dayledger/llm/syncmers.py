"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer of units (words, or characters of short texts and of texts without spaces) is an anchor if
the least hash among its inner substrings stands first or last. That depends on the k-mer alone, so
equal passages have equal anchors wherever they stand. A fingerprint holds all anchors with their
places, and so grows with the text; likeness counts the shared anchors shifted like a neighbour of
theirs. An anchor that a text has several times counts as often: the second is told from the first, the
third from both, and the n-th of one text is compared with the n-th of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.operators.sizing import checked_broadcast
from dayledger.sinks.staging import stage

DRIFT = 32  # units by which a matching anchor may be shifted against the one before or behind it
SHORT, LONG = 300, 600  # characters: words count above the first, characters up to the second
UNSPACED = 16  # characters a word, above which the text is taken by characters too
WORDS, CHARACTERS = (2, 4), (4, 12)  # units in an inner substring, inner substrings in a k-mer
BUCKET_BITS = 8  # a range holds 256 ids
ANCHORS = ["own_a", "own_ap", "own_c", "own_cp"]


def fingerprinted(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with arrays {name}_w, {name}_wp, {name}_c, {name}_cp: hashes and places of the anchors by
    words and by characters; null where that unit is not used. {name}_a, {name}_ap: those by words of
    every text, short ones too. `text` must not be null."""
    return _by_words(_anchored(df, text, name), text, name)


def _anchored(df: DataFrame, text: str, name: str) -> DataFrame:
    length, units = F.char_length(text), f"_{name}_words"
    df = df.withColumn(units, F.split(text, "\\s+"))
    by_characters = (length <= LONG) | (F.size(units) * UNSPACED < length)
    characters = f"_{name}_characters"
    df = df.withColumn(characters, F.when(by_characters, F.split(text, "")))
    for column, (inner, wide), short in ((units, WORDS, "a"), (characters, CHARACTERS, "c")):
        df = _anchors(df, column, text, inner, wide, f"{name}_{short}")
    return df.drop(units, characters)


def _by_words(df: DataFrame, text: str, name: str) -> DataFrame:
    by_words = F.char_length(text) > SHORT
    return df.withColumns({f"{name}_{w}": F.when(by_words, F.col(f"{name}_{a}")) for w, a in (("w", "a"), ("wp", "ap"))})


def _anchors(df: DataFrame, units: str, text: str, inner: int, wide: int, out: str) -> DataFrame:
    """Each array is made in a column of its own and read at least twice or as the argument of one
    function, so that the optimizer computes it once a row and not once an element."""
    steps = {"hash": "_hash", "inner": "_inner", "sorted": "_sorted", "first": "_first"}
    df = df.withColumn(steps["hash"], F.transform(units, lambda u: F.xxhash64(u)))
    parts = F.col(steps["hash"])
    for i in range(1, inner):
        parts = F.zip_with(parts, _from(steps["hash"], i), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    df = df.withColumn(steps["inner"], parts)
    # the minimum of the inner hashes behind the first, the last, and a hash of the whole k-mer
    zipped = F.arrays_zip(*(_from(steps["inner"], i) for i in range(wide)))

    def anchor(k: Column, i: Column) -> Column:
        hashes = [k[str(i)] for i in range(wide)]
        low = F.least(*hashes)
        at_edge = (hashes[0] == low) | (hashes[-1] == low)
        whole = F.xxhash64(*hashes[::inner], hashes[-1])
        return F.when(hashes[-1].isNotNull() & at_edge, whole.bitwiseAND(_bits(HASH)).bitwiseOR((i + 1).cast("long")))

    # hash and place in one number: sorted, the places of one hash stand together
    df = df.withColumn(steps["sorted"], F.sort_array(F.array_compact(F.transform(zipped, anchor))))
    # the how-manieth of its hash each is: equal ones stand together, so they are found by halving
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(PLACE_BITS))])

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.shiftright(F.get(steps["sorted"], i), 32) == F.shiftright(x, 32), F.lit(False))

    def before(x: Column, i: Column) -> Column:
        count = F.aggregate(halves, F.lit(0), lambda n, half: n + F.when(same(x, i - n - half), half).otherwise(0))
        return F.when(same(x, i - 1), count).otherwise(0)

    def numbered(x: Column, n: Column) -> Column:
        again = F.xxhash64(F.shiftright(x, 32), n).bitwiseAND(_bits(HASH)).bitwiseOR(x.bitwiseAND(_bits(PLACE)))
        return F.when(n == 0, x).otherwise(again)

    each = F.zip_with(steps["sorted"], F.transform(steps["sorted"], before), numbered)
    # a text too short for a syncmer is one anchor as a whole
    alone = F.array(F.xxhash64(text).bitwiseAND(_bits(HASH)))
    df = df.withColumn(steps["first"], F.when(F.size(steps["sorted"]) > 0, each).when(F.col(units).isNotNull(), alone))
    return df.withColumns({
        out: F.transform(steps["first"], lambda x: F.shiftright(x, 32).cast("int")),
        f"{out}p": F.transform(steps["first"], lambda x: x.bitwiseAND(_bits(PLACE)).cast("int")),
    }).drop(*steps.values())


PLACE_BITS = 31
HASH, PLACE = -1 << 32, (1 << 32) - 1  # the halves of a number that holds both


def _bits(mask: int) -> Column:
    return F.lit(mask).cast("long")


def _from(array: str, start: int) -> Column:
    return F.slice(array, start + 1, 1 << 30)


def fingerprint(name: str) -> Column:
    """The fingerprint as text: for each unit its letter, the anchors' hashes in the order of their places
    in base64, and a hexadecimal digit for how far each place is from the one before. That is less than
    `wide`: of as many k-mers in a row one is an anchor."""

    def part(unit: str) -> Column:
        placed = F.array_sort(F.zip_with(f"{name}_{unit}p", f"{name}_{unit}", lambda p, h: F.shiftleft(p.cast("long"), 32).bitwiseOR(
            h.cast("long").bitwiseAND(_bits(PLACE)))))
        hashes = F.transform(placed, lambda x: F.lpad(F.hex(x.bitwiseAND(_bits(PLACE))), 8, "0"))
        steps = F.zip_with(placed, F.concat(F.array(F.lit(0).cast("long")), placed), lambda x, y: F.lower(F.hex(F.shiftright(x, 32) - F.shiftright(y, 32))))
        return F.when(F.col(f"{name}_{unit}").isNotNull(), F.concat(
            F.lit(f"{unit}:"), F.base64(F.unhex(F.array_join(hashes, ""))), F.lit(":"), F.array_join(steps, "")))

    return F.concat_ws(";", part("w"), part("c"))


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """`df` with `out`, how alike two fingerprints are, 0 to 1: of the anchors of both together, the share
    that both have at matching places. Characters are compared where both have them, else the words of
    both, however short.

    A shared anchor is at a matching place if it is shifted like the shared anchor before or behind it,
    within DRIFT units: what is inserted or removed elsewhere does not matter, nor does a passage that
    moved as a whole. The only shared anchor matches. As in `_anchors`, arrays are columns read twice."""
    steps = [f"_{out}_{step}" for step in ("both", "shared", "shifts", "agree")]
    both, shared, shifts, agree = steps

    def tagged(name: str, side: int) -> Column:
        def unit(short: str) -> Column:
            return F.zip_with(f"{name}_{short}", f"{name}_{short}p", lambda h, p: F.shiftleft(h.cast("long"), 32).bitwiseOR(
                F.shiftleft(p.cast("long"), 1)).bitwiseOR(_bits(side)))

        characters = F.col(f"{a}_c").isNotNull() & F.col(f"{b}_c").isNotNull()
        return F.when(characters, unit("c")).otherwise(unit("a"))

    def pair(x: Column, y: Column) -> Column:
        """Both places of an anchor, that in `a` first; null of two anchors."""
        px, py = (F.shiftright(z.bitwiseAND(_bits(PLACE)), 1) for z in (x, y))
        first = x.bitwiseAND(_bits(1)) == 0
        places = F.shiftleft(F.when(first, px).otherwise(py), 32).bitwiseOR(F.when(first, py).otherwise(px))
        return F.when(F.shiftright(x, 32) == F.shiftright(y, 32), places)

    df = df.withColumn(both, F.sort_array(F.concat(tagged(a, 0), tagged(b, 1))))
    df = df.withColumn(shared, F.sort_array(F.array_compact(F.zip_with(both, _from(both, 1), pair))))
    df = df.withColumn(shifts, F.transform(shared, lambda x: F.shiftright(x, 32) - x.bitwiseAND(_bits(PLACE))))
    df = df.withColumn(agree, F.zip_with(shifts, _from(shifts, 1), lambda x, y: F.abs(x - y) <= DRIFT))
    # of shared anchors, those that agree with the one before or behind; the last has none behind
    in_place = F.size(F.filter(F.zip_with(F.concat(F.array(F.lit(False)), agree), agree, lambda x, y: x | y), lambda x: x))
    n = F.when(F.size(shared) == 1, F.lit(1)).otherwise(in_place)
    together = F.size(both) - F.size(shared)
    return df.withColumn(out, F.when(together > 0, n / together).otherwise(F.lit(0.0))).drop(*steps)


def followed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and next_text, the text of the next row in ascending doc_id, of the
    first row after the last, and the anchors of both: own_a, own_ap, own_c, own_cp and next_a and so on, found
    once for each row, which then goes to the one before with them. Rows of one id follow each other by text;
    a row without an id has no next text, which counts as empty.

    Ids are cut into ranges of 256; a range is ordered in one task, with the first row of the next
    range that has any as a guest at its end.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bucket = F.shiftright("doc_id", BUCKET_BITS)
    has_id = rows.where("doc_id IS NOT NULL")
    ranges = stage(has_id.groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("first")), "ranges")
    after = _next(ranges.select(F.col("bucket").alias("value")))
    # one row per range of 256 ids, broadcast if measured to be small
    hosts = after.join(ranges, after["next"] == ranges["bucket"]).select(F.col("value").alias("bucket"), "first")
    hosts = checked_broadcast(stage(hosts, "hosts"))
    guests = has_id.join(hosts, F.col("doc_id") == F.col("first")).select("bucket", "doc_id", "text", F.lit(True).alias("guest"))
    # rows without an id are spread by their text and ordered with nothing
    own = rows.select(F.coalesce(bucket, F.xxhash64("text")).alias("bucket"), "doc_id", "text", F.lit(False).alias("guest"))
    places, order = ["loose", "bucket"], ["guest", "doc_id", "text"]
    # anchors are found behind the shuffle, which moves the texts alone, and before the window
    dealt = own.unionByName(guests).withColumn("loose", F.col("doc_id").isNull()).repartition(*places)
    told = _anchored(dealt.sortWithinPartitions(*places, *order), "text", "own")
    order = Window.partitionBy(*places).orderBy(*order)
    following = F.when(F.col("doc_id").isNotNull(), F.lead(F.struct("text", *ANCHORS)).over(order))
    # the empty text is too short for a syncmer: one anchor as a whole, by either unit
    whole, place = F.array(F.shiftright(F.xxhash64(F.lit("")), 32).cast("int")), F.array(F.lit(0))
    empty = F.struct(F.lit("").alias("text"), *[(place if c.endswith("p") else whole).alias(c) for c in ANCHORS])
    return (
        told.withColumn("_next", F.coalesce(following, empty)).where("NOT guest")
        .select("doc_id", "text", *ANCHORS, F.col("_next.text").alias("next_text"),
                *[F.col(f"_next.{c}").alias(c.replace("own", "next")) for c in ANCHORS])
    )


def _next(values: DataFrame) -> DataFrame:
    """value and next of distinct longs: the next larger one, after the largest the smallest. Works in
    ranges of 256 values, and on the ranges themselves until they too lie within one."""
    dealt = values.withColumn("bucket", F.shiftright("value", BUCKET_BITS))
    ranges = stage(dealt.groupBy("bucket").agg(F.min("value").alias("first")), "ranges")
    low, high = ranges.agg(F.min("bucket"), F.max("bucket")).first()
    if low is None or high - low < 1 << BUCKET_BITS:  # at most 256 rows in one window
        together = Window.partitionBy(F.lit(0)).orderBy("bucket")
        smallest = F.min("first").over(Window.partitionBy(F.lit(0)))
        after = ranges.select("bucket", F.coalesce(F.lead("first").over(together), smallest).alias("first"))
    else:
        order = _next(ranges.select(F.col("bucket").alias("value")))
        after = order.join(ranges, order["next"] == ranges["bucket"]).select(F.col("value").alias("bucket"), "first")
    following = F.lead("value").over(Window.partitionBy("bucket").orderBy("value"))
    return stage(
        dealt.withColumn("following", following).join(after, "bucket")
        .select("value", F.coalesce("following", "first").alias("next")), "order",
    )


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter of characters is replaced
    by the first as many (or all) of the next text: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (likeness to the edited and to the next text)."""
    df = followed(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    df = df.withColumn("edited", edited)
    df = fingerprinted(_by_words(df, "text", "own"), "edited", "edited")
    df = likeness(likeness(df, "own", "edited", "near_edited"), "own", "next", "near_next")
    return df.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("edited").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
