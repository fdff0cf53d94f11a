"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptally.session import apply_conf, materialise  # noqa: F401

# The white space that separates words (space, tab, \n, \v, \f, \r).
SPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings of the text queries: small Arrow batches, as texts can be long."""
    apply_conf(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """body(value) with ``value`` evaluated once: inside a lambda a plain expression is
    evaluated anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op, block: int = 256) -> Column:
    """Running values of an array: op(running value before, value), the first before being null.

    They run inside blocks of ``block`` items and then over the blocks' last values, so an
    array of n items costs about n * block steps and not n * n."""
    last = lambda a: F.try_element_at(a, F.lit(-1))

    def run(a):
        return F.aggregate(a, F.slice(a, F.lit(1), F.lit(0)), lambda acc, x: F.array_append(acc, op(last(acc), x)))

    def of_blocks(blocks):
        return let(run(F.transform(blocks, last)), lambda totals: F.flatten(F.transform(blocks, lambda a, i: let(
            F.get(totals, i - 1), lambda before: F.transform(a, lambda x: op(before, x))))))

    def whole(v):
        starts = F.sequence(F.lit(1), F.size(v), F.lit(block))
        return F.when(F.size(v) > 0, let(F.transform(starts, lambda i: run(F.slice(v, i, F.lit(block)))), of_blocks)
                      ).otherwise(v)
    return let(values, whole)


def prefix_sums(lens: Column) -> Column:
    """Running sums of an int array as bigints."""
    longs = F.transform(lens, lambda x: x.cast("bigint"))
    return running(longs, lambda a, x: F.coalesce(a, F.lit(0).cast("bigint")) + x)


def cut(text: Column, spans: Column, block: int = 256) -> Column:
    """array<string>: the text of every span; starts and ends of ``spans`` ascend.

    A place in a string takes a scan, so the text is cut for ``block`` spans at a time first."""
    part = lambda t, a, z: t.substr((a + 1).cast("int"), (z - a).cast("int"))

    def of_block(t, own):
        first = F.get(own, F.lit(0))["start"]
        return let(first, lambda a: let(part(t, a, F.element_at(own, -1)["end"]), lambda near: F.transform(
            own, lambda s: part(near, s["start"] - a, s["end"] - a))))

    def whole(t, all_):
        starts = F.sequence(F.lit(1), F.size(all_), F.lit(block))
        return F.when(F.size(all_) > 0, F.flatten(F.transform(starts, lambda i: let(
            F.slice(all_, i, F.lit(block)), lambda own: of_block(t, own))))).otherwise(F.array().cast("array<string>"))
    return let(text, lambda t: let(spans, lambda all_: whole(t, all_)))


def match_spans(text: Column, matches: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the matches of ``pattern`` in ``text``.

    ``matches`` holds regexp_extract_all(text, pattern, 0). The pieces between
    matches come from split() with the same pattern, so offsets are running sums
    of piece and match lengths (code points, end exclusive). Texts without a
    match are not split."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def spans(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = prefix_sums(F.zip_with(gaps, found, lambda g, m: F.length(g) + F.length(m)))
        return F.zip_with(found, ends, lambda m, e: F.struct(
            (e - F.length(m)).alias("start"), e.alias("end"), m.alias("value")))
    return let(matches, lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(none))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, for an array of structs sorted already."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(docs: DataFrame, text_col: str, kinds: list, out: str) -> DataFrame:
    """Add ``out``: array<struct<start, rank, kind, end, value>>, by start, then kind as listed.

    ``kinds``: (name, pattern, keep), where ``keep(value)`` says which matches stay;
    the others are dropped without another try inside them."""
    tmp = [f"__m{i}" for i in range(len(kinds))]
    found = docs.withColumns({t: F.regexp_extract_all(F.col(text_col), F.lit(p), F.lit(0))
                              for t, (_, p, _) in zip(tmp, kinds, strict=True)})

    def kept(i: int) -> Column:
        kind, pattern, keep = kinds[i]
        spans = F.filter(match_spans(F.col(text_col), F.col(tmp[i]), pattern), lambda s: keep(s["value"]))
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(i).alias("rank"), F.lit(kind).alias("kind"),
                                                     s["end"], s["value"]))
    each = [kept(i) for i in range(len(kinds))]
    return found.withColumn(out, F.array_sort(F.concat(*each))).drop(*tmp)


def replace_spans(text: Column, spans: Column, by) -> Column:
    """``text`` with every span replaced by ``by(span, length)``; spans are sorted by start.

    Overlapping spans give one replacement, by the first of them: ``length`` is that of their union."""
    long = lambda x: x.cast("bigint")

    def pieces(t, all_, ends):
        # (start, end, span, until): the text before a span that no earlier one touches, and its union's end
        before = F.transform(all_, lambda s, i: F.struct(
            F.coalesce(F.get(ends, i - 1), long(F.lit(0))).alias("start"), long(s["start"]).alias("end"), s.alias("span")))
        kept = F.filter(before, lambda g: g["end"] >= g["start"])
        whole = F.struct(F.element_at(ends, -1).alias("start"), long(F.length(t)).alias("end"))
        return let(kept, lambda gaps: let(cut(t, F.concat(F.transform(gaps, lambda g: F.struct(g["start"], g["end"])),
                                                          F.array(whole))), lambda parts: F.array_join(F.transform(
            parts, lambda p, i: F.when(i < F.size(gaps), F.concat(p, let(F.get(gaps, i), lambda g: by(g["span"], F.coalesce(
                F.get(gaps, i + 1)["start"], whole["start"]) - g["end"])))).otherwise(p)), "")))

    def replaced(t, all_):
        ends = running(F.transform(all_, lambda s: long(s["end"])), lambda a, x: F.greatest(a, x))
        return F.when(F.size(all_) > 0, let(ends, lambda e: pieces(t, all_, e))).otherwise(t)
    return let(text, lambda t: let(spans, lambda all_: replaced(t, all_)))
