"""Records of delimited files: lines, or several lines where a quoted cell holds line breaks.

Whether a line begins inside a quoted cell depends on everything before it.  Each line only says what it does to that state:
it leaves it, flips it or settles it.  These effects are composed along the lines of a split and along the splits of a file,
so a file is read in any number of splits, and lines meet only where a record really spans several of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.operators.skew import lookup
from hustings.session import materialise

SPLIT = ["source", "_split"]


def escaped(separator: str) -> str:
    return "\\" + separator if separator in "|.^$*+?()[]{}\\" else separator


def opens(line: Column, separator: str, inside: bool) -> Column:
    """Whether a quoted cell is still open at the end of a line that begins outside, or inside, one."""
    sep = escaped(separator)
    text = r'[^"]*+(?:""[^"]*+)*+'
    cell = rf'(?:"{text}"[^{sep}]*+|[^"{sep}][^{sep}]*+|)'
    left_open = rf'(?:{cell}{sep})*+"{text}\z'
    return line.rlike(rf'\A{text}(?:\z|"[^{sep}]*+{sep}{left_open})' if inside else rf"\A{left_open}")


def composed(before: Column, along: W, first: Column, second: Column) -> tuple[Column, Column]:
    """What the effects of all earlier rows come to: the state after them if it began outside, or inside.

    ``before`` counts the earlier rows that flip the state; ``first`` and ``second`` are a row's two outcomes.
    """
    settled = F.last(F.when(first == second, F.struct(first.alias("state"), before.alias("flips"))), True).over(along)
    odd = (before - F.coalesce(settled["flips"], F.lit(0))) % 2 == 1
    return tuple(F.coalesce(settled["state"], F.lit(begin)) != odd for begin in (False, True))


def flips_before(along: W, first: Column, second: Column) -> Column:
    return F.coalesce(F.sum((first & ~second).cast("bigint")).over(along), F.lit(0))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """One record per line: its number within the file is that of the lines before its split plus its place there."""
    splits = lines.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_lines"), F.min("_seq").alias("_first"))
    before = F.sum("_lines").over(W.partitionBy("source").orderBy("_split")) - F.col("_lines")
    starts = splits.withColumn("_start", before).withColumnRenamed("_lines", "_n")
    placed = lookup(lines, starts, SPLIT, ["_seq"], "inner")
    number = (F.col("_start") + F.col("_seq") - F.col("_first")).alias("row_idx")
    return placed.select("source", number, "value", F.lit(False).alias("loose"))


def split_states(marked: DataFrame) -> DataFrame:
    """Per split: the state it begins in (``_inside``), the next one's, lines and records before it, and how its file ends."""
    last = F.max_by(F.struct("open0", "open1", "in0", "in1"), "_seq")
    splits = marked.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_seq").alias("_first"),
        F.count_if(~F.col("in0")).alias("_starts0"),
        F.count_if(~F.col("in1")).alias("_starts1"),
        last.alias("_last"),
    )
    ends = [F.when(F.col(f"_last.in{s}"), F.col("_last.open1")).otherwise(F.col("_last.open0")) for s in (0, 1)]
    splits = splits.withColumns({"_end0": ends[0], "_end1": ends[1]})
    in_file = W.partitionBy("source").orderBy("_split")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_flips", flips_before(earlier, F.col("_end0"), F.col("_end1")))
    splits = splits.withColumn("_inside", composed(F.col("_flips"), earlier, F.col("_end0"), F.col("_end1"))[0])
    starts = F.when(F.col("_inside"), F.col("_starts1")).otherwise(F.col("_starts0"))
    end = F.when(F.col("_inside"), F.col("_end1")).otherwise(F.col("_end0"))
    whole = W.partitionBy("source")
    return splits.select(
        *SPLIT,
        "_n",
        "_first",
        "_inside",
        F.lead("_inside").over(in_file).alias("_next"),
        (F.sum("_n").over(in_file) - F.col("_n")).alias("_lines"),
        (F.sum(starts).over(in_file) - starts).alias("_records"),
        F.sum(starts).over(whole).alias("_all_records"),
        F.max_by(end, "_split").over(whole).alias("_unclosed"),
    )


def joined_records(lines: DataFrame) -> DataFrame:
    """Records of files in which some quoted cell spans lines; ``lines`` has ``open0`` and ``open1``."""
    in_split = W.partitionBy(*SPLIT).orderBy("_seq")
    earlier = in_split.rowsBetween(W.unboundedPreceding, -1)
    first, second = F.col("open0"), F.col("open1")
    marked = lines.withColumn("_flips", flips_before(earlier, first, second))
    in0, in1 = composed(F.col("_flips"), earlier, first, second)
    marked = marked.withColumns({"in0": in0, "in1": in1})
    so_far = in_split.rowsBetween(W.unboundedPreceding, 0)
    counted = marked.withColumns(
        {
            "_nth0": F.sum((~F.col("in0")).cast("bigint")).over(so_far),
            "_nth1": F.sum((~F.col("in1")).cast("bigint")).over(so_far),
            "_then0": F.lead("in0").over(in_split),
            "_then1": F.lead("in1").over(in_split),
        }
    )
    placed = lookup(counted, materialise(split_states(marked)), SPLIT, ["_seq"], "inner")

    def which(name: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    record = F.col("_records") + which("_nth") - 1
    loose = F.col("_unclosed") & (record == F.col("_all_records") - 1)
    rows = materialise(
        placed.select(
            "source",
            "value",
            record.alias("record"),
            (F.col("_lines") + F.col("_seq") - F.col("_first")).alias("line"),
            loose.alias("loose"),
            (which("in") | F.coalesce(which("_then"), F.col("_next"), F.lit(False))).alias("several"),
        )
    )
    alone = rows.where("not loose and not several").select("source", F.col("record").alias("row_idx"), "value", "loose")
    pieces = F.array_sort(F.collect_list(F.struct("line", "value")))
    together = (
        rows.where("several and not loose")
        .groupBy("source", F.col("record").alias("row_idx"))
        .agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"), F.lit(False).alias("loose"))
    )
    unclosed = rows.where("loose")
    begins = unclosed.groupBy("source").agg(F.min("line").alias("_begin"), F.count(F.lit(1)).alias("_n"))
    singly = lookup(unclosed, begins, ["source"], ["line"], "inner").select(
        "source", (F.col("record") + F.col("line") - F.col("_begin")).alias("row_idx"), "value", "loose"
    )
    return alone.unionByName(together).unionByName(singly)


def records(lines: DataFrame) -> DataFrame:
    """``source, row_idx, value, loose``, one row per record, from a written table of lines.

    ``lines`` is ``source, _split, _seq, value, open0, open1``: where the split begins, an order within it, and whether a
    quoted cell is open after the line, had it begun outside or inside one.  Only files in which a cell is left open by some
    line go through more than numbering.  Line breaks within a record become ``\\n``.  A quote that is never closed joins
    nothing: from its record on every line of the file is a record of its own, and ``loose``.
    """
    torn = materialise(lines.where("open0").groupBy("source").agg(F.count(F.lit(1)).alias("torn")))
    if torn.isEmpty():
        return numbered_lines(lines)
    tagged = lookup(lines, torn, ["source"], ["_seq"])
    usual = numbered_lines(tagged.where("torn is null").drop("torn"))
    return usual.unionByName(joined_records(tagged.where("torn is not null").drop("torn")))
