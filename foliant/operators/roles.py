"""Who did what on which edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.nulls import col, fold


def role_edges(editions: DataFrame, roles: dict[str, str], edition: str = "edition", actors: DataFrame | None = None, actor: str = "actor") -> DataFrame:
    """actor, role, edition from the role columns (column name to role); a cell names one actor.

    With a table of known actors only theirs stay, by semi-join.
    """
    ed = fold(editions[edition].cast("string")).alias("edition")
    pairs = F.array(*[F.struct(fold(editions[c].cast("string")).alias("actor"), F.lit(r).alias("role")) for c, r in roles.items()])
    e = editions.select(ed, F.inline(F.filter(pairs, lambda x: x["actor"].isNotNull()))).where("edition IS NOT NULL")
    if actors is not None:
        known = actors.select(F.col(actor).cast("string").alias("actor")).distinct()
        e = e.join(known, "actor", "left_semi")
    return e.select("actor", "role", "edition")


def role_map(edges: DataFrame) -> DataFrame:
    """actor, role_edition_map (role to sorted distinct editions), roles (sorted)."""
    per = edges.groupBy("actor", "role").agg(F.array_sort(F.collect_set("edition")).alias("e"))
    made = per.groupBy("actor").agg(F.array_sort(F.collect_list(F.struct("role", "e"))).alias("m"))
    return made.select("actor", F.map_from_entries("m").alias("role_edition_map"), F.transform("m", lambda x: x["role"]).alias("roles"))


def encode_role_map(c: Column | str) -> Column:
    """role:id1,id2;role:id3"""
    return F.array_join(F.transform(F.array_sort(F.map_entries(col(c))), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ","))), ";")


def parse_role_map(df: DataFrame, actor: str, cell: str) -> DataFrame:
    """actor, role, edition_id of every entry of an encoded cell; parts without both sides are skipped."""
    parts = df.select(F.col(actor).alias("actor"), F.explode(F.split(F.col(cell), ";")).alias("p")).where(F.col("p").contains(":"))
    role = F.trim(F.substring_index("p", ":", 1))
    ids = F.substring(F.col("p"), F.instr(F.col("p"), ":") + 1, F.length("p"))
    e = parts.select("actor", role.alias("role"), F.explode(F.split(ids, ",")).alias("edition_id")).withColumn("edition_id", F.trim("edition_id"))
    return e.where("role != '' AND edition_id != ''")


def resolve_editions(edges: DataFrame, editions: DataFrame, id_column: str = "edition_id", iri: str = "edition_iri") -> tuple[DataFrame, DataFrame]:
    """Edges with the IRI of their edition, and those whose id no edition has."""
    known = editions.select(F.col(id_column), F.col(iri)).dropDuplicates([id_column])
    return edges.join(known, id_column), edges.join(known, id_column, "left_anti")


def several_roles(mapped: DataFrame) -> DataFrame:
    """Actors with more than one role."""
    return mapped.where(F.size("roles") > 1)
