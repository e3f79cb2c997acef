"""Document fingerprints from spot signatures, compared by pruned Jaccard similarity.

A spot is a common word; its signature is the chain of the next content words. Chains stand in
running prose and hardly in lists and menus, and a small edit changes only the chains about it.
Sets of signatures are compared only between documents whose set sizes admit the similarity, and
only where the rarest signatures of both meet. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import bounds_of, let, range_of, spread, stored

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from had has have he her his i in is it its not of on or she that the their they this to was "
    "were what which with you "
    "aber als am auf aus bei das dem den der des die ein eine einem einen einer er es für im ist mit nicht sich sie und von vor "
    "war werden wird wie zu zum zur "
    "au aux avec ce ces dans de du elle en est et il je la le les leur lui mais ne nous on ou où par pas pour qu que qui sa se ses "
    "son sont sur un une vous y "
    "al como con del el ella ellos entre era esta este ha las lo los me mi muy no nos para pero por si sin sobre su sus también te "
    "una yo"
).split()
#: Content words in a chain, found among so many words behind the spot.
CHAIN, AHEAD = 3, 12
THRESHOLD = 0.75


def _is_anchor(word: Column) -> Column:
    return word.isin(ANCHORS)


def _name(chain: Column) -> Column:
    return F.substring(F.md5(chain), 1, 16)


def signatures(text: Column) -> Column:
    """The sorted set of signatures of a text, as 16 hexadecimal digits; empty for a null or empty text.

    A text without any spot has one signature, of all its words, or of its characters if it has
    no words, so that equal texts still meet.
    """

    def of_words(words: Column) -> Column:
        def chain(word: Column, i: Column) -> Column:
            content = F.slice(F.filter(F.slice(words, i + 2, AHEAD), lambda w: ~_is_anchor(w)), 1, CHAIN)
            return F.when(_is_anchor(word), let(content, lambda c: F.when(F.size(c) > 0, _name(F.concat_ws(" ", word, c)))))

        spots = F.filter(F.transform(words, chain), lambda s: s.isNotNull())
        alone = F.array(_name(F.concat(F.lit(" "), F.when(F.size(words) > 0, F.array_join(words, " ")).otherwise(text))))
        return let(spots, lambda s: F.array_sort(F.array_distinct(F.when(F.size(s) > 0, s).otherwise(alone))))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    none = F.array().cast("array<string>")
    return F.when(F.length(text) > 0, let(words, of_words)).otherwise(none)


def fingerprint(found: Column) -> Column:
    """A set of signatures as one string: 16 hexadecimal digits each, in order."""
    return F.array_join(found, "")


def likeness(one: Column, two: Column) -> Column:
    """The Jaccard similarity of two sets; that of two empty sets is 1."""
    both = F.size(F.array_intersect(one, two))
    either = F.size(one) + F.size(two)
    return let(both, lambda n: F.when(either == 0, 1.0).otherwise(n / (either - n))).cast("double")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (a, b, likeness) of classes of equal fingerprints, and doc_id to class.

    A class is called by its smallest doc_id. Two sets can only reach ``threshold`` if the smaller
    has at least that share of the larger one's size and if they share one of their rarest
    signatures, as many as may be missing plus one; only such pairs are compared. Null doc_ids and
    texts without signatures are left out.
    """
    sets = docs.select(F.col("doc_id").cast("long"), signatures(F.col("text").cast("string")).alias("own"))
    sets = sets.where("doc_id IS NOT NULL AND size(own) > 0").withColumn("name", F.xxhash64("own"))
    sets = stored(sets, "signature-sets")
    classes = sets.groupBy("name", F.size("own").alias("n")).agg(F.min("doc_id").alias("class_id"))
    members = sets.join(classes.select("name", "class_id"), "name").select("doc_id", "class_id")
    one_each = sets.join(classes, F.col("doc_id") == F.col("class_id"), "left_semi").dropDuplicates(["doc_id"])
    one_each = stored(one_each.select("doc_id", "own"), "class-sets")
    terms = one_each.select("doc_id", F.size("own").alias("n"), F.explode("own").alias("term"))
    rarity = terms.groupBy("term").agg(F.count("*").alias("df")).where("df > 1")
    # signatures that no other class has can't be shared, but count as the rarest ones
    ranked = terms.join(rarity, "term", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "term"))
    rarest = ranked.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1)
    rarest = stored(rarest.where("df > 1").select("doc_id", "n", "term"), "rarest")
    other = rarest.toDF("b", "m", "term")
    close = (F.col("a") < F.col("b")) & (F.least("n", "m") >= threshold * F.greatest("n", "m") - 1e-9)
    pairs = rarest.withColumnRenamed("doc_id", "a").join(other, "term").where(close).select("a", "b").distinct()
    left, right = one_each.toDF("a", "left"), one_each.toDF("b", "right")
    compared = pairs.join(right, "b").join(left, "a").select("a", "b", likeness(F.col("left"), F.col("right")).alias("likeness"))
    return compared.where(F.col("likeness") >= threshold), members


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``next_text`` of the document that follows in descending doc_id; the first follows the last.

    Documents are dealt out by ranges of doc_id with about as many rows each. The first document of
    a range is also sent to the range before it, so each range finds all its successors. Rows that
    share a doc_id stand in the order of their texts; rows without one come last.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place"))
    bounds = bounds_of(ids, "place", 2 * spread(docs.sparkSession))
    placed = rows.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    placed = placed.withColumn("range", range_of(F.col("place"), bounds))
    firsts = ids.groupBy(range_of(F.col("place"), bounds).alias("range")).agg(F.max("place").alias("place"))
    # as many rows as there are ranges
    firsts = sorted((r["range"], r["place"]) for r in firsts.collect())
    ghosts = {place: above for (_, place), (above, _) in zip(firsts, firsts[1:] + firsts[:1])}
    sent_to = F.lit(None).cast("int")
    if ghosts:
        listed = docs.sparkSession.createDataFrame(sorted(ghosts.items()), "ghost_place long, ghost_range int")
        placed = placed.join(F.broadcast(listed), F.col("place") == F.col("ghost_place"), "left").drop("ghost_place")
        sent_to = F.col("ghost_range")
    copies = F.when(sent_to.isNull(), F.array(F.struct("range", F.lit(0).alias("ghost")))).otherwise(
        F.array(F.struct("range", F.lit(0).alias("ghost")), F.struct(sent_to.alias("range"), F.lit(1).alias("ghost")))
    )
    dealt = placed.select("doc_id", "text", "place", F.inline(copies))
    order = Window.partitionBy("range").orderBy("ghost", F.col("place").desc(), "text")
    own = signatures(F.col("text"))
    found = dealt.select("doc_id", "text", "place", "range", "ghost", F.lead("text").over(order).alias("next_text"))
    found = found.select("*", own.alias("own"))
    found = found.select("doc_id", "text", "next_text", "ghost", "own", F.lead("own").over(order).alias("next_own"))
    return found.where("ghost = 0").drop("ghost")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and two similarities.

    The edited text has its last third replaced by the first characters of the next document. A
    null text counts as empty: no characters, an empty fingerprint, and an edited text that is
    empty too. A table of one row is its own next document.
    """
    rows = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", signatures(F.col("edited")).alias("edited_own"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def _like_sql(one: str, two: str) -> str:
    both = f"len(list_intersect({one}, {two}))"
    return f"CASE WHEN len({one}) + len({two}) = 0 THEN 1::DOUBLE ELSE {both} / (len({one}) + len({two}) - {both})::DOUBLE END"


#: The same with every text's signatures from lists.
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS (
  SELECT r, doc_id, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text, length(text) AS n
  FROM t WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, text)
),
e AS (SELECT *, substring(text, 1, n - n // 3) || substring(next_text, 1, n // 3) AS edited FROM f),
split AS (
  SELECT text, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: w <> '') AS words
  FROM (SELECT text FROM e UNION SELECT edited FROM e) WHERE text <> ''
),
marked AS (SELECT *, list_transform(words, lambda w: list_contains([{", ".join(f"'{a}'" for a in ANCHORS)}], w)) AS a FROM split),
spots AS (
  SELECT text, words, list_filter(list_transform(range(1, len(words) + 1), lambda i: CASE WHEN a[i] THEN
    [words[i]] || list_transform(list_filter(range(i + 1, least(i + {AHEAD + 1}, len(words) + 1)), lambda j: NOT a[j])[1:{CHAIN}], lambda j: words[j])
  END), lambda c: c IS NOT NULL AND len(c) > 1) AS chains FROM marked
),
named AS (
  SELECT text, CASE WHEN len(chains) > 0 THEN list_sort(list_distinct(list_transform(chains, lambda c: substr(md5(array_to_string(c, ' ')), 1, 16))))
    WHEN len(words) > 0 THEN [substr(md5(' ' || array_to_string(words, ' ')), 1, 16)] ELSE [substr(md5(' ' || text), 1, 16)] END AS own
  FROM spots
),
sets AS (
  SELECT e.*, coalesce(x.own, []) AS own, coalesce(y.own, []) AS edited_own, coalesce(z.own, []) AS next_own
  FROM e LEFT JOIN named x ON e.text = x.text LEFT JOIN named y ON e.edited = y.text LEFT JOIN named z ON e.next_text = z.text
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, coalesce(array_to_string(own, ''), '') AS fingerprint,
       coalesce(array_to_string(edited_own, ''), '') AS edited_fingerprint,
       {_like_sql("own", "edited_own")} AS near_edited, {_like_sql("own", "next_own")} AS near_next
FROM sets
"""
