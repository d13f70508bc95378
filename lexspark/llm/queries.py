"""The operators with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.llm import encoding, lookalikes, mixing, neardup, packing, splitting, subjects
from lexspark.llm.sentences import sentence_units
from lexspark.session import written


def _t(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def _texts(spark: SparkSession, base: str) -> DataFrame:
    """src, fld, ord, text of the two long fields."""
    raw = _t(spark, base, "raw_documents").select(F.lit("raw_documents").alias("src"), F.lit("filedata").alias("fld"), "ord", F.col("filedata").alias("text"))
    law = _t(spark, base, "law_documents").select(F.lit("law_documents").alias("src"), F.lit("original_content").alias("fld"), "ord", F.col("original_content").alias("text"))
    return raw.unionAll(law)


def _values(spark: SparkSession, base: str, *fields: tuple[str, str]) -> DataFrame:
    """src, fld, ord, text of some fields."""
    out = None
    for src, fld in fields:
        v = _t(spark, base, src).select(F.lit(src).alias("src"), F.lit(fld).alias("fld"), "ord", F.col(fld).alias("text"))
        out = v if out is None else out.unionAll(v)
    return out


def p1_pieces(spark: SparkSession, base: str) -> DataFrame:
    """Every text of the two fields in pieces, under the limits of size_limits."""
    return splitting.split_oversized(_texts(spark, base), splitting.read_limits(_t(spark, base, "size_limits")))


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    """Records that the operator had to cut: those with a second piece."""
    return p1_pieces(spark, base).where("piece_no = 1").select("src", "ord")


def p1_invariants(spark: SparkSession, base: str) -> DataFrame:
    """What holds of the pieces of each text: how many characters they cover, and how many of them are too long, hold
    anything but the text at their place, or don't begin the overlap before the end of the one before."""
    limits = splitting.read_limits(_t(spark, base, "size_limits"))
    bound = spark.createDataFrame([(s, f, m, o) for (s, f), (m, o) in limits.items()], "src string, fld string, max_size long, overlap long")
    pieces = splitting.split_oversized(_texts(spark, base), limits).join(F.broadcast(bound), ["src", "fld"], "left")  # a row per field
    text = _texts(spark, base).select("src", F.col("ord").cast("long").alias("ord"), "text")
    pieces = pieces.join(text, ["src", "ord"]).withColumn("stored", F.substring("text", F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos"))).drop("text")
    end = F.lag("end_pos").over(Window.partitionBy("src", "ord").orderBy("piece_no"))  # the pieces of one text
    pieces = pieces.withColumn("due", F.when(F.col("piece_no") == 0, 0).otherwise(end - F.col("overlap")))
    wrong = (F.col("end_pos") - F.col("start_pos") > F.col("max_size")) | (F.col("piece") != F.col("stored")) | (F.col("start_pos") != F.col("due"))
    return pieces.groupBy("src", "ord").agg(F.max("end_pos").alias("chars"), F.count_if(wrong).alias("wrong"))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    values = _values(spark, base, ("raw_documents", "filedata"), ("law_documents", "filename"))
    return encoding.find_garbled(values, with_text=False).select("src", "fld", "ord")


def p2_repaired(spark: SparkSession, base: str) -> DataFrame:
    """The garbled values with chain, posterior and repaired text."""
    return encoding.find_garbled(_values(spark, base, ("raw_documents", "filedata"), ("law_documents", "filename")))


def _p3(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    docs = _t(spark, base, "raw_documents").select(F.col("ord").alias("id"), F.col("filedata").alias("text"))
    return neardup.near_duplicates(docs, words=3, similarity=0.6)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    """The pairs as TESTDATA.md defines them: three words, similarity 0.6."""
    return neardup.all_pairs(*_p3(spark, base))


def p3_groups(spark: SparkSession, base: str) -> DataFrame:
    """Every document with its group and its class's number of links."""
    members, links = _p3(spark, base)
    return neardup.groups(members, written(links, "links"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    """Values whose consistent form differs, but for those that are garbled (all three fields are judged)."""
    values = _values(spark, base, ("raw_documents", "filedata"), ("law_documents", "filename"), ("law_documents", "title"))
    cases = lookalikes.consistent_form(values, only_cases=True)
    return encoding.without_garbled(cases, encoding.learn(values), "src", "fld", "ord")


def p5_forms(spark: SparkSession, base: str) -> DataFrame:
    """Every value in its consistent form."""
    values = _values(spark, base, ("raw_documents", "filedata"), ("law_documents", "filename"), ("law_documents", "title"))
    return lookalikes.consistent_form(values).drop("text")


def p4_units(spark: SparkSession, base: str) -> DataFrame:
    """Every unit with its place and text."""
    return sentence_units(_texts(spark, base), "text", ["src", "ord"])


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """The places of all units."""
    return p4_units(spark, base).select("src", "ord", "start_pos")


def _sizes(spark: SparkSession, base: str) -> DataFrame:
    """The documents' stored sizes; texts aren't read, as TESTDATA.md has every size stored."""
    return _t(spark, base, "documents").select(F.col("doc_id").alias("item"), F.col("n_tokens").alias("size"), "source")


def p6_packed(spark: SparkSession, base: str) -> DataFrame:
    """Every document in containers of the size that size_limits gives for `pack`."""
    capacity = splitting.read_limits(_t(spark, base, "size_limits"), "pack")["documents", "text"][0]
    return packing.pack_containers(_sizes(spark, base), capacity)


def p6_invariants(spark: SparkSession, base: str) -> DataFrame:
    """What holds of the containers, as figures: items and tokens as given, containers above the capacity, items in pieces
    though they would fit, pieces given twice or lacking."""
    capacity = splitting.read_limits(_t(spark, base, "size_limits"), "pack")["documents", "text"][0]
    packed = p6_packed(spark, base)
    over = packed.groupBy("container").agg(F.sum("size").alias("s")).agg(F.count_if(F.col("s") > capacity).alias("overfull"))
    items = packed.groupBy("item").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.count_distinct("piece").alias("d"), F.max("piece").alias("last"))
    figures = items.agg(
        F.count("*").alias("items"), F.sum("s").alias("tokens"), F.count_if((F.col("s") <= capacity) & (F.col("n") > 1)).alias("cut_needlessly"),
        F.count_if((F.col("n") != F.col("d")) | (F.col("last") != F.col("n") - 1)).alias("pieces_wrong"),
    )
    return figures.crossJoin(F.broadcast(over))  # one row each


def p7_schedule(spark: SparkSession, base: str) -> DataFrame:
    """The selection in its order."""
    return mixing.mix(_sizes(spark, base), _t(spark, base, "source_weights"))[0]


def p7_invariants(spark: SparkSession, base: str) -> DataFrame:
    """What holds of the schedule, as figures: records used more often than allowed, blocks that start before their release
    or before the one before them has ended, places given twice, sources that drift by a block (the largest) or more."""
    weights = _t(spark, base, "source_weights")
    s = p7_schedule(spark, base)
    used = s.groupBy("source", "item").agg(F.count("*").alias("n")).join(F.broadcast(weights.select("source", "max_repeats")), "source")  # a row per source
    over = used.agg(F.count_if(F.col("n") > F.col("max_repeats")).alias("overused"))
    own = s.agg(F.count_if(F.col("start") < F.col("release")).alias("early"), (F.count("*") - F.count_distinct("position")).alias("places_twice"), F.max("size").alias("most"))
    # A source has had release * w tokens when its block begins at start, so that start - release, times w, is its drift.
    live = weights.join(F.broadcast(s.select("source").distinct()), "source", "left_semi").select("source", "target_share")
    share = F.col("target_share") / F.sum("target_share").over(Window.partitionBy())  # one row per source
    drift = s.join(F.broadcast(live.select("source", share.alias("w"))), "source").crossJoin(F.broadcast(own.select("most")))
    late = drift.agg(F.count_if((F.col("start") - F.col("release")) * F.col("w") >= F.col("most")).alias("drifted"))
    return own.drop("most").crossJoin(F.broadcast(over)).crossJoin(F.broadcast(late))  # one row each


def p7_report(spark: SparkSession, base: str) -> DataFrame:
    """The shares reached."""
    return mixing.mix(_sizes(spark, base), _t(spark, base, "source_weights"))[1]


def p8_subjects(spark: SparkSession, base: str) -> DataFrame:
    """Documents by area with shares."""
    return subjects.document_subjects(_t(spark, base, "documents"), _t(spark, base, "subjects"), _t(spark, base, "subject_examples"))


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return p8_subjects(spark, base).select("doc_id", "subject")


def p8_composition(spark: SparkSession, base: str) -> DataFrame:
    """How many documents deal with each area."""
    return p8_subjects(spark, base).groupBy("subject").agg(F.count("*").alias("documents"), F.sum("sentences").alias("sentences"))
