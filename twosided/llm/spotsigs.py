"""Document fingerprints by SpotSigs, in DataFrame expressions.

A spot is a common word; its signature is the common word and the chain of the next ``CHAIN`` content words after it,
with common words between them passed over. A text's fingerprint is the set of its signatures, so navigation and other text
without common words hardly counts. Two sets are compared by the Jaccard coefficient, which is at most the ratio of
their sizes; so pairs of too different sizes are pruned before they are compared, and :func:`near_pairs` looks for pairs
only within partitions of similar set sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twosided.llm.common import col, let, text_of
from twosided.session import materialise

#: Content words of a chain, and the coefficient from which texts are near-duplicates.
CHAIN, MIN_JACCARD = 2, 0.8

# Common words of English, French, German and Spanish: fixed values.
COMMON = (
    "a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this to "
    "was were which will with you "
    "au aux ce ces dans de des du elle en est et il la le les leur ne ou par pas pour que qui se son sur un une "
    "als auf aus das dem den der des die ein eine er es im ist mit nach nicht sich sie sind und von zu zum "
    "al como con del el ella los las lo no para por se su una uno y"
).split()


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted array of the different signatures of a text, 32-bit hashes.

    Words are runs of letters and digits in lower case. A text without signatures has the hash of all its words as its only
    one, so different short texts differ and texts without words are alike.
    """
    def content(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - 1)
        return F.filter(places, lambda i: ~F.get(words, i).isin(*COMMON))

    def signed(words: Column, places: Column) -> Column:
        def at(j: Column) -> Column:
            before = F.when(j == 0, -1).otherwise(F.get(places, j - 1))
            follow = [F.get(words, F.get(places, j + k)) for k in range(chain)]
            return F.transform(F.slice(words, before + 2, F.get(places, j) - before - 1), lambda spot: F.hash(spot, *follow))

        starts = F.when(F.size(places) >= chain, F.sequence(F.lit(0), F.size(places) - chain))
        return F.array_sort(F.array_distinct(F.flatten(F.transform(starts, at))))

    def whole(words: Column) -> Column:
        return let(let(content(words), lambda places: signed(words, places)), lambda found: F.when(
            F.size(found) > 0, found).otherwise(F.array(F.hash(F.lit(chain), F.array_join(words, " ")))))

    return let(_words(text), whole)


def fingerprint(found: Column) -> Column:
    """Signatures as one string of eight hexadecimal digits each."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """The Jaccard coefficient of two arrays of signatures, or 0 without a comparison where their sizes rule out ``at_least``."""
    x, y = F.size(a), F.size(b)
    compared = let(F.size(F.array_intersect(a, b)), lambda shared: shared / (x + y - shared))
    return F.when(F.least(x, y) < F.lit(at_least) * F.greatest(x, y), 0.0).otherwise(compared)


def size_class(size: Column, at_least: float = MIN_JACCARD) -> Column:
    """The partition of a set size: sets alike by ``at_least`` lie in one partition or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / -math.log(at_least) + 1e-9).cast("int")


def near_pairs(df: DataFrame, id_col: str, text_col: str, at_least: float = MIN_JACCARD) -> tuple[DataFrame, DataFrame]:
    """Pairs of different fingerprints that are alike, and the members of each fingerprint's class.

    The pairs are ``(a, b, likeness)``, each once, with ``a`` and ``b`` the smallest ids of two classes of equal fingerprints; the
    members are ``(id, class)``. A set's rarest signatures, as many as two alike sets must share one of, are joined within the
    set's partition and its neighbour; what meets is pruned by size and compared. Null texts count as empty; a class whose
    ids are all null is left out of the pairs. Repeated rows are members twice.
    """
    rows = materialise(df.select(col(id_col).alias("id"), signatures(text_of(text_col)).alias("s")), "signatures")
    classes = materialise(rows.groupBy("s").agg(F.min("id").alias("class")).filter("class is not null"), "classes")
    size = F.size("s")
    spots = classes.select("class", F.explode("s").alias("spot"))
    common = spots.groupBy("spot").agg(F.count("*").alias("n"))
    ranked = spots.join(common, "spot").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("by_n"))
    short = ranked.withColumn("k", F.size("by_n") - F.ceil(F.size("by_n") * at_least - 1e-9) + 1)
    prefix = short.select("class", size_class(F.size("by_n"), at_least).alias("part"), F.explode(
        F.slice("by_n", F.lit(1), F.col("k").cast("int"))).alias("p")).select("class", "part", "p.spot")
    prefix = materialise(prefix, "prefixes")
    other = prefix.select(F.col("class").alias("other"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    met = prefix.join(other, ["part", "spot"]).filter("class != other").select(
        F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()
    sets = classes.select("class", "s")
    both = met.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    pairs = both.withColumn("likeness", likeness(F.col("x"), F.col("y"), at_least)).filter(F.col("likeness") >= at_least)
    return pairs.select("a", "b", "likeness"), rows.join(classes, "s", "left").select("id", "class")


def _neighbours(df: DataFrame) -> DataFrame:
    """``(own, chosen, previous, length)``: each key, the smallest hash of its texts, the key before it, of the first the last,
    and the length of that one's longest text.

    Keys are dealt out by range, so only keys of a range are sorted in one task; the ranges' ends meet in a table of one row
    for each range.
    """
    own = df.groupBy("key").agg(F.max(F.char_length("text")).alias("length"), F.min(F.xxhash64("text")).alias("chosen"))
    ranged = materialise(own.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "ranges")
    here = F.struct("key", "length")
    ends = Window.orderBy("part")
    final = F.last("last").over(ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = ranged.groupBy("part").agg(F.max(here).alias("last")).select(
        "part", F.coalesce(F.lag("last").over(ends), final).alias("before"))
    within = Window.partitionBy("part").orderBy("key")
    return ranged.withColumn("here", F.lag(here).over(within)).join(before, "part").withColumn(
        "from", F.coalesce("here", "before")).select(F.col("key").alias("own"), "chosen", F.col("from.key").alias("previous"), "from.length")


def against_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each row of ``df``: its fingerprint, that of its edited text, and two likenesses.

    The edited text has its last half, floor(n / 2) code points, replaced by as many, or all, from the start of the next
    document; next by ascending id, a null id before all others, and after the last the first. Among rows of one id the next
    document is the one with the smallest text hash. A null text counts as empty; no rows give no rows.
    """
    # The key is never null: a null id is one that is not known, which comes first.
    key = F.struct(col(id_col).isNotNull().alias("known"), col(id_col).alias("id")).alias("key")
    docs = df.select(key, text_of(text_col).alias("text"))
    near = materialise(_neighbours(docs), "neighbours")
    # Not an equality of two columns, so that the join stays one by id alone and both joins share a shuffle of the texts.
    chosen = F.xxhash64("text").bitwiseXOR(F.col("chosen")) == 0
    first = docs.join(near, F.col("key") == F.col("own")).filter(chosen)
    heads = first.select(
        F.col("previous").alias("to"), signatures(F.col("text")).alias("next_signatures"),
        F.substr("text", F.lit(1), F.floor(F.col("length") / 2).cast("int")).alias("head"),
    ).groupBy("to").agg(F.first("head").alias("head"), F.first("next_signatures").alias("next_signatures"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.char_length("text") - half), F.substr("head", F.lit(1), half))
    both = docs.join(heads, F.col("key") == F.col("to")).select("key.id", "next_signatures", "text", edited.alias("edited"))
    told = let(F.struct(signatures(F.col("text")).alias("x"), signatures(F.col("edited")).alias("y")), lambda s: F.struct(
        fingerprint(s["x"]).alias("fingerprint"), fingerprint(s["y"]).alias("edited_fingerprint"),
        likeness(s["x"], s["y"]).alias("near_edited"), likeness(s["x"], F.col("next_signatures")).alias("near_next"),
        size_class(F.size(s["x"])).alias("size_class")))
    return both.select("id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       told.alias("told")).select("id", "n_chars", "edited_sha256", "told.*")
