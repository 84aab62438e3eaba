"""Queries for table names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowlake.functions import naming
from rowlake.queries import fixtures as fx

# File names around each page, as Spark SQL and as the SQL of the comparison.
_FILES = {
    "url": ("url", "url"),
    "windows": (r"concat(r'C:\in\Orders-', page_id, '.v1.csv')", r"'C:\in\Orders-' || page_id || '.v1.csv'"),
    "plain": ("concat('/a/b/c', page_id)", "'/a/b/c' || page_id"),
    "folder": ("concat('/a/b', page_id, '/')", "'/a/b' || page_id || '/'"),
    "hidden": ("concat('/a/.rc', page_id)", "'/a/.rc' || page_id"),
    "hidden_ext": ("concat('/a/..rc', page_id, '.bak')", "'/a/..rc' || page_id || '.bak'"),
    "empty": ("if(page_id % 2 = 0, '', null)", "case when page_id % 2 = 0 then '' end"),
}


def _files(spark, sf_dir):
    variants = F.array(*[F.struct(F.lit(n).alias("variant"), F.expr(c).alias("filename")) for n, (c, _) in _FILES.items()])
    return fx.table(spark, sf_dir, "pages").select("page_id", F.inline(variants))


_FILES_SQL = "with f as (" + " union all ".join(
    f"select page_id, '{name}' as variant, {sql} as filename from pages" for name, (_, sql) in _FILES.items()
) + ")"


def logical_name(spark, sf_dir):
    name = naming.logical_table_name(F.col("filename"))
    return _files(spark, sf_dir).select(
        "page_id", "variant", name.alias("table_name"), naming.default_name(name).alias("named")
    )


_LOGICAL = "regexp_replace(string_split(replace(filename, '\\', '/'), '/')[-1], '\\.[^.]+$', '')"
LOGICAL_NAME = f"""{_FILES_SQL}
select page_id, variant, {_LOGICAL} as table_name, coalesce(nullif({_LOGICAL}, ''), 'unknown') as named from f
"""


def logical_name_posix(spark, sf_dir):
    return _files(spark, sf_dir).select(
        "page_id", "variant", naming.logical_table_name_posix(F.col("filename")).alias("table_name")
    )


LOGICAL_NAME_POSIX = f"""{_FILES_SQL}, b as (select *, string_split(filename, '/')[-1] as base from f)
select page_id, variant, case
  when coalesce(filename, '') = '' then 'unknown'
  when instr(ltrim(base, '.'), '.') = 0 then base
  else left(base, length(base) - instr(reverse(base), '.')) end as table_name from b
"""

_NAMES = {
    "schema": ("concat('public.', c_name)", "'public.' || c_name"),
    "quoted": ("concat('\"', c_name, '\"')", "'\"' || c_name || '\"'"),
    "padded": ("concat('  ', c_name, ' ')", "'  ' || c_name || ' '"),
    "dashed": ("concat('a-b.c-d.e', c_custkey)", "'a-b.c-d.e' || c_custkey"),
    "long": ("concat(repeat(c_mktsegment, 8), c_custkey)", "repeat(c_mktsegment, 8) || c_custkey"),
    "trailing": ("concat(c_name, '.')", "c_name || '.'"),
    "blank": ("if(c_custkey % 2 = 0, '   ', null)", "case when c_custkey % 2 = 0 then '   ' end"),
}


def _names(spark, sf_dir):
    variants = F.array(*[F.struct(F.lit(n).alias("variant"), F.expr(c).alias("name")) for n, (c, _) in _NAMES.items()])
    return fx.table(spark, sf_dir, "customer").select("c_custkey", F.inline(variants))


_SAFE_SQL = (
    "coalesce(nullif(replace(replace(trim(case when contains(trim(name), '.') "
    "then substr(trim(name), instr(trim(name), '.') + 1) else trim(name) end, '\"'), '.', '_'), '-', '_'), ''), 'unknown')"
)
_NAMES_SQL = (
    "with n as ("
    + " union all ".join(f"select c_custkey, '{v}' as variant, {sql} as name from customer" for v, (_, sql) in _NAMES.items())
    + f"), s as (select *, {_SAFE_SQL} as safe from n)"
)


def _named(spark, sf_dir, **columns: Column):
    return _names(spark, sf_dir).select("c_custkey", "variant", *[c.alias(n) for n, c in columns.items()])


def sanitize_name(spark, sf_dir):
    return _named(spark, sf_dir, table_name=naming.sanitize_table_name(F.col("name")))


def physical_name(spark, sf_dir):
    identity = naming.table_identity(F.col("name"))
    return _named(
        spark, sf_dir,
        lake_name=naming.physical_table_name(F.col("name")),
        rdbms_name=naming.physical_table_name(F.col("name"), "rdbms"),
        logical_part=identity["logical_name"],
        physical_part=identity["physical_name"],
    )


def target_path(spark, sf_dir):
    return _named(
        spark, sf_dir,
        lake_path=naming.target_path("/lake//", F.col("name")),
        rdbms_path=naming.target_path("/lake/", F.col("name"), "rdbms"),
    )


def operation_table_name(spark, sf_dir):
    return _named(
        spark, sf_dir,
        lake_name=naming.operation_table_name(F.col("name")),
        rdbms_name=naming.operation_table_name(F.col("name"), "rdbms"),
    )


# A logical name is sanitized again on its way to a physical one; it has no dot left by then.
QUERIES = {
    "logical_name": (logical_name, LOGICAL_NAME),
    "logical_name_posix": (logical_name_posix, LOGICAL_NAME_POSIX),
    "sanitize_name": (sanitize_name, f"{_NAMES_SQL} select c_custkey, variant, safe as table_name from s"),
    "physical_name": (
        physical_name,
        f"{_NAMES_SQL} select c_custkey, variant, lower(safe) as lake_name, left(safe, 63) as rdbms_name, "
        "safe as logical_part, lower(safe) as physical_part from s",
    ),
    "target_path": (
        target_path,
        f"{_NAMES_SQL} select c_custkey, variant, '/lake/' || lower(safe) as lake_path, '/lake' as rdbms_path from s",
    ),
    "operation_table_name": (
        operation_table_name,
        f"{_NAMES_SQL} select c_custkey, variant, lower(replace(replace(coalesce(name, ''), '.', '_'), '-', '_')) as lake_name, "
        "replace(replace(coalesce(name, ''), '.', '_'), '-', '_') as rdbms_name from s",
    ),
}
