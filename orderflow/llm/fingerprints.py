"""Document fingerprints from closed syncmers of words, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word: letters, marks and digits in a row. Scripts without blanks give a word per character.
WORD = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]+"
#: Words of an anchor, and of the inner pieces whose hashes are compared. The code below is for these two.
K, S = 7, 2
#: Anchors under which two texts are compared by finer pieces.
FEW = 8
#: Rows that are ordered together to find each row's successor, and the most such buckets.
BUCKET_ROWS, FAN = 500, 32


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the anchors of a text column: 32-bit hashes, distinct, in order of their first place.

    Of each ``K`` words in a row, the ``K - S + 1`` inner pairs are hashed; the K-word piece is an anchor
    (closed syncmer) if the least of these hashes is at its first or last pair. That depends on the piece alone,
    so equal passages give equal anchors wherever they stand, and at least every ``K - S``-th piece is one. A text
    without any (fewer than eleven words or so, or no blanks) has the finer pieces of its characters instead (see
    ``with_pieces``); an empty one has none. ``{name}_worded`` tells whether the anchors are pieces of words.
    """
    h, s, m = f"_{name}_h", f"_{name}_s", f"_{name}_m"
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(s, F.transform(h, lambda a, i: F.xxhash64(a, F.get(h, i + 1))))
    df = df.withColumn(m, F.transform(s, lambda a, i: F.least(a, F.get(s, i + 1))))

    def anchor(first: Column, i: Column) -> Column:
        last = F.get(s, i + (K - S))
        inner = F.least(F.get(m, i + 1), F.get(m, i + 3))
        closed = (i <= F.size(h) - K) & (F.least(first, last) <= inner)
        return F.when(closed, F.hash(first, F.get(s, i + 2), F.get(s, i + 4), F.get(h, i + 6)))

    df = df.withColumn(name, F.array_distinct(F.array_compact(F.transform(s, anchor))))
    df = df.withColumn(f"{name}_worded", F.size(name) > 0)
    df = with_pieces(df, text, F.when(~F.col(f"{name}_worded"), F.lit(True)), f"{name}_fine")
    return df.withColumn(name, F.coalesce(f"{name}_fine", name)).drop(h, s, m, f"{name}_fine")


def with_pieces(df: DataFrame, text: str, characters: Column, name: str) -> DataFrame:
    """Adds finer pieces of a text column, as hashes.

    If ``characters``, closed syncmers (with pairs inside) of four characters of the words, which are joined by single
    blanks: at least every second piece is one, so two texts with five equal characters in a row share one. Else each
    three words in a row. Null where ``characters`` is null. A text without any has its whole as one piece; an empty one
    has none.
    """
    u, s = f"_{name}_u", f"_{name}_s"
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    letters = F.regexp_extract_all(F.array_join(words, " "), F.lit("(?s)."), F.lit(0))
    df = df.withColumn(u, F.when(characters, letters).when(~characters, words))
    df = df.withColumn(s, F.transform(u, lambda w, i: F.xxhash64(w, F.get(u, i + 1))))

    def piece(first: Column, i: Column) -> Column:
        last = F.get(s, i + 2)
        closed = (i <= F.size(u) - 4) & (F.least(first, last) <= F.get(s, i + 1))
        return F.when(characters & closed, F.hash(first, last)).when(~characters & (i < F.size(u) - 2), F.hash(first, F.get(u, i + 2)))

    df = df.withColumn(name, F.array_distinct(F.array_compact(F.transform(s, piece))))
    whole = F.when(F.size(u) > 0, F.hash(F.col(u))).otherwise(F.hash(F.col(text)))
    short = F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(F.array(whole))
    return df.withColumn(name, F.when(F.size(name) == 0, short).otherwise(F.col(name))).drop(u, s)


def with_likeness(df: DataFrame, one: tuple[str, str], other: tuple[str, str], name: str) -> DataFrame:
    """Adds the likeness of two texts, each given by the columns of its text and of its anchors.

    If one of them has no anchors of words, both are compared by pieces of characters; if one has fewer than ``FEW``, by
    pieces of three words.
    """
    (text, a), (text2, b) = one, other
    worded = F.col(f"{a}_worded") & F.col(f"{b}_worded")
    few = F.least(F.size(a), F.size(b)) < FEW
    empty = (F.length(text) == 0) | (F.length(text2) == 0)
    # Null where the anchors do: those of both texts are of words and many, or of characters already.
    characters = F.when(empty, None).when(~worded, F.lit(True)).when(few, F.lit(False))
    df = df.withColumn(f"{name}_by", characters)
    for at, (own, anchors) in enumerate((one, other)):
        ready = F.col(f"{name}_by") & ~F.col(f"{anchors}_worded")
        df = with_pieces(df, own, F.when(~F.coalesce(ready, F.lit(False)), F.col(f"{name}_by")), f"{name}_{at}")
        df = df.withColumn(f"{name}_{at}", F.coalesce(f"{name}_{at}", anchors))
    return df.withColumn(name, likeness(F.col(f"{name}_0"), F.col(f"{name}_1"))).drop(f"{name}_by", f"{name}_0", f"{name}_1")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors by all anchors of two texts, as sets: places and repeats don't count; 1 if neither has any."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def as_text(anchors: Column) -> Column:
    return F.array_join(anchors.cast("array<string>"), ",")


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its id and ``anchors`` (array of int). No shuffle; cases as in ``with_anchors``."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    return with_anchors(narrow, "text", "anchors").select(F.col("id").alias(id_column), "anchors")


def _bucket(bounds: list[int], value: Column) -> Column:
    """The number of bounds (sorted, at most FAN ** 3) up to ``value``, less one, by a FAN-ary search."""

    def literal(numbers: list[int]) -> Column:
        return F.array(*(F.lit(n) for n in numbers)).cast("array<long>")

    at = F.lit(0)
    for step in (FAN * FAN, FAN, 1):
        if step > 1 and len(bounds) <= step:
            continue
        wider = step * FAN
        rows = [literal(bounds[begin : begin + wider][::step][1:]) for begin in range(0, len(bounds), wider)]
        probes = F.get(F.array(*rows), (at / wider).cast("int"))
        at = at + step * F.size(F.filter(probes, lambda b: b <= value))
    return at


def compare_with_next(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of texts, of their edited texts, and their likeness to these and to the next document.

    The edited text has its last floor(n / 2) code points replaced by as many of the next document's first ones.
    Documents are ordered by id; after the last comes the first. To find successors without sorting everything in
    one task, the ids are cut at quantiles into buckets; a bucket's first row, whose id is the cut itself, is
    also sent to the bucket before. The texts are shuffled once.

    Columns: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (anchors joined by commas),
    ``near_edited``, ``near_next``. A null text is empty. Rows with a null id have no successor: their next text is
    empty. Rows of one id are ordered by text; an only row is its own successor. Two empty texts are alike (1). An
    empty table gives no rows; other columns are not read. Texts with few anchors are compared by finer pieces (see
    ``with_likeness``), so the likeness can be above 0 where the two fingerprints have nothing in common.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    rows = narrow.where("id IS NOT NULL").count()
    wanted = max(1, min(FAN**3, rows // BUCKET_ROWS))
    cuts = F.percentile_approx("id", F.array(*(F.lit(i / wanted) for i in range(wanted))), F.lit(max(10_000, 4 * wanted)))
    found = narrow.agg(F.min("id").alias("least"), cuts.alias("cuts")).first()
    bounds = sorted({found.least, *found.cuts}) if rows else [0]

    known = with_anchors(narrow, "text", "anchors")
    with_id = known.where("id IS NOT NULL").withColumn("bucket", _bucket(bounds, F.col("id")))
    first = F.get(F.array(*(F.lit(b) for b in bounds)), F.col("bucket")) == F.col("id")
    before = F.pmod(F.col("bucket") - 1, F.lit(len(bounds)))
    host = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(first, F.array(host, guest)).otherwise(F.array(host))
    placed = with_id.select("id", "text", "anchors", "anchors_worded", F.inline(places))
    order = Window.partitionBy("bucket").orderBy("guest", "id", "text")
    following = F.lead(F.struct("text", "anchors", "anchors_worded")).over(order)
    ordered = placed.withColumn("next", following).where(~F.col("guest")).drop("bucket", "guest")
    nothing = F.struct(F.lit("").alias("text"), F.array().cast("array<int>").alias("anchors"), F.lit(False).alias("anchors_worded"))
    paired = ordered.unionByName(known.where("id IS NULL").withColumn("next", nothing))

    half = F.floor(F.length("text") / 2).cast("int")
    kept, taken = F.substring("text", F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half)
    edited = paired.withColumn("edited", F.concat(kept, taken))
    both = with_anchors(edited, "edited", "edited_anchors")
    both = both.withColumns({"next_text": F.col("next.text"), "next_anchors": F.col("next.anchors"), "next_anchors_worded": F.col("next.anchors_worded")})
    both = with_likeness(both, ("text", "anchors"), ("edited", "edited_anchors"), "near_edited")
    both = with_likeness(both, ("text", "anchors"), ("next_text", "next_anchors"), "near_next")
    return both.select(
        F.col("id").alias(id_column),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
