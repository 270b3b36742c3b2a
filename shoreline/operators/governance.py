"""Comments and tags on tables, and reports on how well tables are described."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

TAG_PREFIX = "tag."


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def set_table_comment(spark: SparkSession, table: str, comment: str) -> None:
    """Describe a table."""
    spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")


def set_column_comments(spark: SparkSession, comments: Mapping[str, Mapping[str, str]]) -> list[str]:
    """Describe many columns (table to column to text); returns the names that do not exist."""
    skipped = []
    for table, columns in comments.items():
        known = set(spark.table(table).columns) if spark.catalog.tableExists(table) else set()
        for column, comment in columns.items():
            if column in known:
                spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT {_quoted(comment)}")
            else:
                skipped.append(f"{table}.{column}")
    return skipped


def set_tags(spark: SparkSession, table: str, tags: Mapping[str, str]) -> None:
    """Tags as table properties."""
    pairs = ", ".join(f"{_quoted(TAG_PREFIX + k)} = {_quoted(v)}" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def table_comment(spark: SparkSession, table: str) -> str | None:
    """The stored comment, wherever it was set: as comment or as table property."""
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return detail.get("Comment") or _properties(spark, table).get("comment")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def metadata_report(spark: SparkSession, tables: Sequence[str], shortest: int = 3) -> DataFrame:
    """Per table: has a comment, columns, columns with a comment longer than ``shortest``."""
    lines = []
    for table in tables:
        columns = spark.catalog.listColumns(table)
        described = sum(1 for c in columns if c.description and len(c.description) > shortest)
        lines.append((table, bool(table_comment(spark, table)), len(columns), described))
    return spark.createDataFrame(
        lines, "table_name string, has_comment boolean, columns int, commented_columns int")


def tag_report(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table, tag, value) for all tags."""
    lines = [(table, key[len(TAG_PREFIX):], value) for table in tables
             for key, value in sorted(_properties(spark, table).items()) if key.startswith(TAG_PREFIX)]
    return spark.createDataFrame(lines, "table_name string, tag string, value string")
