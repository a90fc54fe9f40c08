r"""License scans: an exact set-similarity join of text blocks and templates.

Texts are cut into words, and words into blocks that start every half block,
so any run of up to half a block lies whole inside some block. Blocks have
``block_words`` words, for templates of more than half of that twice, four
times, ... as many, until half a block is as long as the template; so
templates may have any length. A block matches a template when it holds at
least ``containment`` of the template's different words.

The join finds every such pair without comparing all blocks to all templates.
Template words are put in one global order, rarest in the corpus first, from
counts over all documents:

* prefix filter: of a template with ``size`` words of which ``need`` must be
  present, one of the first ``size - need + 1`` is in every matching block,
  so only those words are joined;
* length filter: blocks with fewer than ``need`` words are left out.

There is no positional filter of its own: that ``size - i + 1`` words from
place i of the order reach ``need`` is what the prefix filter already asks.

What is left is verified by the exact intersection. Phrases are templates
that need all their words, verified as consecutive words.

Everything is DataFrame expressions. The words of a text are exploded next to
the join with the prefix words, so only hits leave the scan; a hit table is
pre-aggregated to one row per document before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices whose words, wherever they stand in a block, give a label of the method.
TEMPLATES = {
    "released under the mit license": "mit-notice",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "you can redistribute it under the terms of the gnu general public license": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
    "publish distribute sublicense and or sell copies of the software": "mit-text",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
    "basis without warranties or conditions of any kind either express or implied": "apache-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
    "published by the free software foundation either version 2 of the license or at your option any later version": "gpl-text",
}

_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
_BROADCAST_WORDS = 100_000


@dataclass(frozen=True)
class ScanParams:
    containment: float = 0.8
    block_words: int = 32

    def step(self, template: str) -> int:
        """Words from one block to the next, half a block, for a template."""
        step = self.block_words // 2
        while step < len(template.split()):
            step *= 2
        return step


def text_words(text: Column) -> Column:
    """Words of digits, letters and characters beyond ASCII, case as written; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{_SEPARATORS}+")
    return F.filter(parts, lambda w: w != "")


def _folded(word: Column) -> Column:
    """A-Z as a-z. ``lower`` may also turn other characters into ASCII ones;
    the byte length tells, and such words stay as they are."""
    low = F.lower(word)
    return F.when(F.octet_length(low) == F.octet_length(word), low).otherwise(word)


def _same(word: str, token: str) -> Column:
    """Join condition: ``word`` with A-Z folded is the ``token`` (an ASCII word)."""
    return (F.lower(F.col(word)) == F.col(token)) & (F.octet_length(word) == F.octet_length(token))


def template_words(spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, str], params: ScanParams) -> DataFrame:
    """One row per template and different word: id, kind, label, need, size,
    step, word, at (place in the text), words."""
    rows = []
    for number, (text, label, base) in enumerate([*((t, v, True) for t, v in phrases.items()), *((t, v, False) for t, v in templates.items())]):
        words = text.split()
        size = len(set(words))
        need = size if base else max(1, -int(-(size * params.containment) // 1))
        rows.append(F.struct(
            F.lit(number).alias("id"), F.lit(base).alias("base"), F.lit(label).alias("label"), F.lit(need).alias("need"),
            F.lit(size).alias("size"), F.lit(params.step(text)).alias("step"), F.lit(" ".join(words)).alias("text"),
        ))
    listed = spark.range(1).select(F.inline(F.array(*rows))).withColumn("words", F.split("text", " ")).drop("text")
    each = listed.withColumn("word", F.explode(F.array_distinct("words")))
    return each.withColumn("at", (F.array_position("words", F.col("word")) - 1).cast("int"))


def _small(df: DataFrame, phrases: Sequence[str]) -> DataFrame:
    """Broadcast a table with a row per template word while the templates are
    few; a larger collection is left to Spark's own choice of join."""
    return F.broadcast(df) if sum(len(p.split()) for p in phrases) <= _BROADCAST_WORDS else df


def prefix_words(words: DataFrame, templates: DataFrame, hint) -> DataFrame:
    """The prefix of each template under the global order of word counts."""
    vocabulary = hint(templates.select("word").distinct())
    counts = (
        words.select(F.explode_outer("words").alias("w")).join(vocabulary, _same("w", "word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("id").orderBy(F.coalesce(F.col("n"), F.lit(0)), "word")
    ranked = templates.join(counts, "word", "left").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= F.col("size") - F.col("need") + 1).drop("n")


def scan(
    documents: DataFrame, phrases: Mapping[str, str] | None = None, templates: Mapping[str, str] | None = None,
    params: ScanParams | None = None,
) -> DataFrame:
    """License findings; one row per input row.

    doc_id, n_words, n_base (places of phrases), first_word and last_word
    (smallest and largest place, else null), base_labels, labels (also those
    of matching templates; both different, sorted, comma-joined), score (the
    largest containment of a match; 1 with a phrase, 0 without a match).
    A null or empty text has no words. Repeated rows each give a row. An
    empty table gives no rows; other columns are not read.
    """
    p = params or ScanParams()
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    spark = documents.sparkSession

    def hint(df: DataFrame) -> DataFrame:
        return _small(df, [*phrases, *templates])

    wanted = template_words(spark, phrases, templates, p)
    words = documents.select("doc_id", text_words(F.col("text")).alias("words"))
    prefix = prefix_words(words, wanted, hint).select(
        "id", "base", "label", "need", "size", "step", "rank", "at", F.col("words").alias("template"), F.col("word").alias("token")
    )
    end = spark.range(1).select(  # joins with the end mark that every text gets, so texts without a hit keep their row
        F.lit(-1).alias("id"), F.lit(False).alias("base"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("need"),
        F.lit(0).alias("size"), F.lit(1).alias("step"), F.lit(0).alias("rank"), F.lit(0).alias("at"), F.lit(None).cast("array<string>").alias("template"),
        F.lit("").alias("token"),
    )
    keys = hint(prefix.unionByName(end))
    numbered = words.select(F.monotonically_increasing_id().alias("row"), "doc_id", "words", F.size("words").alias("n_words"))
    exploded = numbered.select(
        "row", "doc_id", "words", "n_words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "word"),
    )
    hits = exploded.join(keys, _same("word", "token"))
    place = F.col("pos") - F.col("at")
    at_place = F.transform(F.slice("words", F.greatest(place, F.lit(0)) + 1, F.size("template")), _folded)
    found = F.col("base") & (place >= 0) & (at_place == F.col("template"))

    def matched(block: Column) -> Column:
        begin, length = block * F.col("step"), 2 * F.col("step")
        inside = F.array_distinct(F.transform(F.slice("words", begin + 1, length), _folded))
        common = F.size(F.array_intersect(inside, F.array_distinct("template")))
        long_enough = F.least(F.col("n_words") - begin, length) >= F.col("need")
        in_reach = F.col("size") - F.col("rank") + 1 >= F.col("need")
        share = F.when((block >= 0) & long_enough & in_reach, common).otherwise(0)
        return F.when(share >= F.col("need"), share / F.col("size")).otherwise(F.lit(0.0))

    own = F.floor(F.col("pos") / F.col("step")).cast("int")
    share = (
        F.when(F.col("id") < 0, F.lit(0.0))
        .when(F.col("base"), F.when(found, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.greatest(matched(own), matched(F.greatest(own - 1, F.lit(0)))))
    )
    judged = hits.select(
        "row", "doc_id", "n_words", share.alias("share"),
        F.when(found, place).alias("place"), F.when(F.col("base"), F.col("label")).alias("base_label"), "label",
    )
    hit = F.col("share") > 0

    def joined(label: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col(label)))), ",")

    return (
        judged.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
            F.count("place").alias("n_base"), F.min("place").cast("long").alias("first_word"),
            F.max("place").cast("long").alias("last_word"), joined("base_label").alias("base_labels"),
            joined("label").alias("labels"), F.max("share").alias("score"),
        ).drop("row")
    )
