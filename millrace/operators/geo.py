"""IP address to location: a range lookup written as equi-joins on address prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.net import ip_to_long
from millrace.lookup import lookup_join, settled
from millrace.session import cut_lineage

# The text returned for an unmatched and for a missing address.
NO_MATCH = "Other IDC"
NULL_MESSAGE = "请传入一个ip"

# A /16 prefix holding more ranges than this is looked up by /24 prefix instead.
DENSE = 16


def parse_ranges(lines: DataFrame, value: str = "value") -> DataFrame:
    """Pipe-delimited lines to ``(start_ip, end_ip, location)``; missing parts become empty."""
    parts = lines.select(F.split(F.col(value), "[|]").alias("p"))
    fields = parts.select(*[F.get("p", F.lit(i)).alias(f"f{i}") for i in (0, 1, 2, 4, 5, 6)])
    shown = [F.coalesce(f"f{i}", F.lit("")) for i in (2, 4, 5, 6)]
    return fields.select(
        ip_to_long(F.col("f0")).alias("start_ip"),
        ip_to_long(F.col("f1")).alias("end_ip"),
        F.concat_ws(",", *shown).alias("location"),
    )


def _cut(pieces: DataFrame) -> DataFrame:
    """Cut ranges at prefix borders: one row per prefix of ``bits`` low bits a range touches.

    A range over a share of the address space becomes as many rows as it has prefixes (65,536 for
    all of it), so tables of nested ranges should be disjoint before they come here.
    """
    unit = F.expr("shiftleft(1L, bits)")
    first = F.expr("shiftright(start_ip, bits)")
    last = F.expr("shiftright(end_ip, bits)")
    low = F.col("prefix") * unit
    return pieces.withColumn("prefix", F.explode(F.sequence(first, last))).select(
        "bits",
        "prefix",
        F.greatest("start_ip", low).alias("start_ip"),
        F.least("end_ip", low + unit - 1).alias("end_ip"),
        "location",
        *[c for c in pieces.columns if c == "origin"],
    )


def _disjoint(cut: DataFrame) -> DataFrame:
    """Pieces of a prefix without overlaps: an address takes the covering range that starts last.

    Prefixes whose pieces are disjoint, as they should be, pass through. In the others every start
    and every address after an end is a border, and each stretch between borders looks for the
    pieces over it, so a range goes on after one nested in it, whatever prefix it began in.
    """
    earlier = Window.partitionBy("prefix").orderBy("start_ip", "origin").rowsBetween(Window.unboundedPreceding, -1)
    meets = F.coalesce(F.col("start_ip") <= F.max("end_ip").over(earlier), F.lit(False))
    marked = cut.withColumn("meets", meets).withColumn("crossed", F.max("meets").over(Window.partitionBy("prefix")))
    marked = cut_lineage(marked.drop("meets"), "range-cuts")
    plain = marked.filter("not crossed").select("prefix", "start_ip", "end_ip", "location")
    crossed = marked.filter("crossed").drop("crossed")
    last = F.shiftleft(F.col("prefix") + 1, 16) - 1
    borders = crossed.select("prefix", F.explode(F.array("start_ip", F.col("end_ip") + 1)).alias("border"))
    borders = borders.filter(F.col("border") <= last).distinct()
    onward = Window.partitionBy("prefix").orderBy("border")
    stretches = borders.withColumn("until", F.coalesce(F.lead("border").over(onward) - 1, last))
    over = (F.col("start_ip") <= F.col("border")) & (F.col("end_ip") >= F.col("border"))
    covered = stretches.join(crossed, "prefix").filter(over).groupBy("prefix", "border", "until")
    best = covered.agg(F.max(F.struct("origin", "end_ip", "location")).alias("r"))
    return plain.union(best.select("prefix", F.col("border"), F.col("until"), "r.location"))


def range_pieces(ranges: DataFrame) -> DataFrame:
    """Disjoint pieces ``(bits, prefix, start_ip, end_ip, location)``, few per prefix.

    Ranges are expected to be disjoint; where they overlap, an address takes the range over it that
    starts last (of several with one start, the longest), so it never has two matches. A /24 prefix
    has at most 256 pieces whatever the input, a /16 prefix at most 65,536.
    """
    one_per_start = (
        ranges.groupBy("start_ip")
        .agg(F.max(F.struct("end_ip", "location", "start_ip")).alias("r"))
        .filter("r.start_ip <= r.end_ip")  # on the result: on the key it would move below the parse
        .select("start_ip", "r.end_ip", "r.location")
    )
    by_prefix = Window.partitionBy("prefix")
    cut = _cut(one_per_start.withColumn("bits", F.lit(16)).withColumn("origin", F.col("start_ip")))
    coarse = _disjoint(cut.drop("bits")).withColumn("n", F.count("*").over(by_prefix))
    bits = F.when(F.col("n") > DENSE, 8).otherwise(16)
    return _cut(coarse.withColumn("bits", bits))


def _match(addresses: DataFrame, pieces: DataFrame, small: bool) -> DataFrame:
    """Add ``_location`` (null when unmatched) for the number column ``_ip``."""
    out = addresses
    for bits in (16, 8):
        side = pieces.filter(F.col("bits") == bits).select(
            F.col("prefix").alias("_p"),
            F.col("start_ip").alias("_s"),
            F.col("end_ip").alias("_e"),
            F.col("location").alias(f"_l{bits}"),
        )
        side = F.broadcast(side) if small else side
        hit = (
            (F.shiftright("_ip", bits) == F.col("_p"))
            & (F.col("_ip") >= F.col("_s"))
            & (F.col("_ip") <= F.col("_e"))
        )
        out = out.join(side, hit, "left").drop("_p", "_s", "_e")
    return out.withColumn("_location", F.coalesce("_l16", "_l8")).drop("_l16", "_l8")


def with_ip_location(
    df: DataFrame,
    ip: str,
    ranges: DataFrame,
    out: str = "location",
    no_match: str = NO_MATCH,
    null_message: str = NULL_MESSAGE,
    small: bool | None = None,
) -> DataFrame:
    """Add the location of the range that holds each address.

    Range tables of measured small size are broadcast and the rows never move. Larger ones are
    matched against the distinct addresses, at most 65,536 in any prefix, and the answers are
    joined back.
    """
    pieces, fits = settled(range_pieces(ranges), "ranges")
    small = fits if small is None else small
    rows = df.withColumn("_ip", ip_to_long(F.col(ip)))
    if small:
        located = _match(rows, pieces, True)
    else:
        distinct = rows.select("_ip").filter("_ip is not null").distinct()
        answers = _match(distinct, pieces, False).filter("_location is not null")
        answers, few = settled(answers, "answers")
        located = lookup_join(rows, answers, "_ip", small=few)
    value = F.when(F.col("_ip").isNull(), null_message).otherwise(
        F.coalesce(F.col("_location"), F.lit(no_match))
    )
    return located.withColumn(out, value).select(*df.columns, out)
