"""Log lines: in memory, in files or from a stream, and their decoding."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import strip
from logweir.schema import ANY_LOG, ANY_LOG_OR_CORRUPT, CORRUPT


def lines_from_list(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "value string")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one stripped record per line."""
    return spark.read.text(path).select(strip("value").alias("value"))


def stream_lines(
    spark: SparkSession, source: str = "text", column: str = "value", **options
) -> DataFrame:
    """Streaming stripped lines from any source: files, or a connector that has them in ``column``."""
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(strip(F.col(column).cast("string")).alias("value"))


# Put behind a line as a record of its own: where it does not come out as the second of two, the line was no single
# record.
_END = "end of line"
NULL_LINE, BLANK_LINE = "<null line>", "<blank line>"


def decode(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Parse JSON lines into the fixed log fields; other input columns are kept.

    A line that is not one JSON object and nothing more leaves its text in ``_corrupt_record`` and fails nothing: a
    broken object, several of them, one with text behind it. A null and a blank line leave a mark that says so.
    """
    line = F.col(line_col)
    enclosed = F.concat(F.lit("["), line, F.lit(f',{{"log_format":"{_END}"}}]'))
    records = F.from_json(enclosed, T.ArrayType(ANY_LOG))
    left = F.when(line.isNull(), NULL_LINE).when(F.length(strip(line)) == 0, BLANK_LINE).otherwise(line)
    nothing = [F.lit(None).cast("string").alias(name) for name in ANY_LOG.names]
    corrupt = F.struct(*nothing, left.alias(CORRUPT))

    def one(found: Column) -> Column:
        record = F.get(found, F.lit(0))
        whole = (F.size(found) == 2) & record.isNotNull() & (F.get(found, F.lit(1))["log_format"] == _END)
        fields = [record[name].alias(name) for name in ANY_LOG.names]
        return F.when(whole, F.struct(*fields, F.lit(None).cast("string").alias(CORRUPT))).otherwise(corrupt)

    others = [c for c in lines.columns if c != line_col]
    # Within the lambda the text is parsed once, however often its fields are used. As a generator the decoding stays
    # in place: Spark would move filters on its fields, such as routing, below a projection and parse again for each.
    return lines.select(*others, F.inline(F.transform(F.array(records), one)))


def quarantine(decoded: DataFrame) -> DataFrame:
    """The undecodable lines."""
    others = [c for c in decoded.columns if c not in ANY_LOG_OR_CORRUPT.names]
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(*others, CORRUPT)


def route(decoded: DataFrame, log_format: str, schema=ANY_LOG) -> DataFrame:
    """Whole records of one log format with that format's columns, in ``schema`` order."""
    others = [c for c in decoded.columns if c not in ANY_LOG_OR_CORRUPT.names]
    whole = decoded.filter(F.col(CORRUPT).isNull())
    return whole.filter(F.col("log_format") == log_format).select(*others, *schema.names)


def unrouted(decoded: DataFrame, formats: list[str]) -> DataFrame:
    """Whole records of any other format, or of none."""
    whole = decoded.filter(F.col(CORRUPT).isNull())
    return whole.filter(~F.coalesce(F.col("log_format").isin(formats), F.lit(False))).drop(CORRUPT)
