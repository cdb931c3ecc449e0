"""JSON, XML, Parquet and database tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import SOURCE_NAME
from quayside.functions.names import clean_name, require_unique
from quayside.operators.flatten import FlattenTarget, flatten_all, flatten_targets
from quayside.operators.schema import cast_leaves_to_string, clean_columns, rename_positional
from quayside.sources.frames import Files, Frame


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_NAME))


@dataclass(frozen=True)
class Json:
    """JSON objects. Without a declared schema, Spark reads the files twice: to infer, then to load."""

    source_system: str
    multi_line: bool = False
    allow_unquoted_field_names: bool = False
    allow_single_quotes: bool = True
    flatten: bool = False
    primitives_as_string: bool = True
    date_format: str | None = None
    timestamp_format: str | None = None
    flatten_targets: Sequence[FlattenTarget] = ()
    schema: T.StructType | None = None

    source_type = "json"

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": ""}]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        reader = files.reader(spark).options(
            multiLine=self.multi_line,
            dropFieldIfAllNull=False,
            allowUnquotedFieldNames=self.allow_unquoted_field_names,
            allowSingleQuotes=self.allow_single_quotes,
            primitivesAsString=self.primitives_as_string,
        )
        if self.date_format:
            reader = reader.option("dateFormat", self.date_format)
        if self.timestamp_format:
            reader = reader.option("timestampFormat", self.timestamp_format)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        df = _with_file(reader.json(list(files.paths)))
        if self.flatten_targets:
            df = flatten_targets(df, self.flatten_targets)
        if self.flatten:
            df = flatten_all(df)
        return [Frame(df, self.type_tokens()[0])]


@dataclass(frozen=True)
class XmlRow:
    """One repeated element. ``infer=False`` with no schema keeps text such as ``007`` as it is.

    With ``split``, large files are cut and read by many tasks: the closing tag ends a record of text, and each element is parsed on its own. The
    elements must not hold elements of their own name, and their closing tags must be written without space and not stand in comments or CDATA sections.
    """

    row_tag: str
    flatten: bool = False
    primitives_as_string: bool = True
    schema: T.StructType | None = None
    infer: bool = True
    split: bool = False


@dataclass(frozen=True)
class Xml:
    source_system: str
    rows: Sequence[XmlRow]

    source_type = "xml"

    def __post_init__(self):
        if not self.rows:
            raise ValueError("rows must not be empty")

    def type_tokens(self) -> list[dict[str, str]]:
        return [
            {"sourceOffset": r.row_tag, "type": r.row_tag, "isFlat": str(r.flatten).lower()} for r in self.rows
        ]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        return [Frame(self._read(spark, files, r), t) for r, t in zip(self.rows, self.type_tokens())]

    def _read(self, spark: SparkSession, files: Files, row: XmlRow) -> DataFrame:
        options = {
            "rowTag": row.row_tag,
            "excludeAttribute": "false",
            "nullValue": "",
            "attributePrefix": "_",
            "valueTag": "_VALUE",
            "ignoreSurroundingSpaces": "false",
            "charset": "UTF-8",
            "inferSchema": str(row.infer).lower(),
        }
        if row.split:
            df = self._read_split(spark, files, row, options)
        else:
            reader = files.reader(spark).options(**options)
            if row.schema is not None:
                reader = reader.schema(row.schema)
            df = _with_file(reader.format("xml").load(list(files.paths)))
        if row.flatten:
            df = flatten_all(df)
        return cast_leaves_to_string(df) if row.primitives_as_string else clean_columns(df)

    @staticmethod
    def _read_split(spark: SparkSession, files: Files, row: XmlRow, options: dict[str, str]) -> DataFrame:
        """Elements cut out of the text between closing tags, so that a file is read in as many tasks as it has splits."""
        text = files.load(spark, "text", lineSep=f"</{row.row_tag}>")
        start = f"<{re.escape(row.row_tag)}(?=[\\s/>])(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>"
        # without content up to its own end, else up to the closing tag, which the reader took away
        found = F.regexp_extract_all("value", F.lit(f"(?s){start}(?:(?<=/>)|.*+)"), F.lit(0))
        whole = F.transform(found, lambda e: F.when(e.rlike(f"(?s)^{start}$") & e.endswith("/>"), e).otherwise(F.concat(e, F.lit(f"</{row.row_tag}>"))))
        elements = text.select(F.explode(whole).alias("element"), F.col("_metadata.file_path").alias(SOURCE_NAME))
        schema = row.schema
        if schema is None:
            strings = getattr(elements.select("element")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
            # the text is read once for the types of all elements
            schema = T._parse_datatype_json_string(spark.read.options(**options)._jreader.xml(strings).schema().json())
        parsed = elements.select(F.from_xml("element", schema, options).alias("element"), SOURCE_NAME)
        return parsed.select("element.*", SOURCE_NAME)


@dataclass(frozen=True)
class Parquet:
    source_system: str
    header_columns: Sequence[str] | None = None

    source_type = "parquet"

    def __post_init__(self):
        if self.header_columns:
            require_unique(map(clean_name, self.header_columns), f"header_columns of {self.source_system}")

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": ""}]

    def read(self, spark: SparkSession, files: Files) -> list[Frame]:
        df = _with_file(files.load(spark, "parquet"))
        if self.header_columns:
            df = rename_positional(df, self.header_columns)
        return [Frame(df, self.type_tokens()[0])]


@dataclass(frozen=True)
class JdbcTable:
    """A table name or a SELECT; with bounds, the read is split on ``partition_column``."""

    name: str
    partition_column: str | None = None
    lower: int | None = None
    upper: int | None = None
    partitions: int | None = None


@dataclass(frozen=True)
class Jdbc:
    """Several database tables, one frame each, with their native types."""

    source_system: str
    url: str
    tables: Sequence[JdbcTable]
    driver: str | None = None
    fetch_size: int | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    source_type = "jdbc"

    @property
    def plain_url(self) -> str:
        """The address without parameters and credentials, which must not reach the rows."""
        return re.sub(r"//[^/@]*@", "//", re.split(r"[?;]", self.url)[0])

    def type_tokens(self) -> list[dict[str, str]]:
        return [{"sourceOffset": "", "type": t.name.replace(" ", "_")} for t in self.tables]

    def options(self, table: JdbcTable) -> dict[str, str]:
        """Reader options of one table."""
        is_query = re.search(r"\bselect\b.*\bfrom\b", table.name, re.IGNORECASE | re.DOTALL)
        options = {"url": self.url, "driver": self.driver, "fetchsize": self.fetch_size, "user": self.user, "password": self.password}
        if table.partition_column:
            options["dbtable"] = f"({table.name}) q" if is_query else table.name
            options |= {
                "partitionColumn": table.partition_column,
                "lowerBound": table.lower,
                "upperBound": table.upper,
                "numPartitions": table.partitions,
            }
        else:
            options["query" if is_query else "dbtable"] = table.name
        return {k: str(v) for k, v in options.items() if v is not None}

    def read(self, spark: SparkSession, files: Files | None = None) -> list[Frame]:
        return [
            Frame(
                spark.read.format("jdbc").options(**self.options(t)).load().withColumn(SOURCE_NAME, F.lit(self.plain_url)),
                tokens,
            )
            for t, tokens in zip(self.tables, self.type_tokens())
        ]
