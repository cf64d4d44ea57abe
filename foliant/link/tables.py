"""Tables of both catalogues brought into the form that matching reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.years import year_of_edition
from foliant.nulls import fold
from foliant.operators.firsts import ROW, last_row_by


def with_authors(core: DataFrame, links: DataFrame, people: DataFrame, key: str = "estc_id", order: str = ROW) -> DataFrame:
    """core with author_ids and authors, arrays in the order first seen, each once.

    links: key, actor_id, is_author (TRUE as text), order. people: actor_id, name; of repeated ids the last row counts.
    """
    names = people.groupBy("actor_id").agg(F.max_by("name", order).alias("name")) if order in people.columns else people.dropDuplicates(["actor_id"])
    a = links.where(F.upper(F.col("is_author")) == "TRUE").groupBy(key, "actor_id").agg(F.min(order).alias("_at"))
    a = a.join(names, "actor_id", "left").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", "actor_id", "name"))).alias("_a"))
    j = core.join(a, key, "left")
    nothing = F.array().cast("array<string>")
    ids, who = F.transform("_a", lambda x: x["actor_id"]), F.array_distinct(F.filter(F.transform("_a", lambda x: x["name"]), lambda x: x.isNotNull()))
    return j.withColumns({"author_ids": F.coalesce(ids, nothing), "authors": F.coalesce(who, nothing)}).drop("_a")


def guess_columns(columns: list[str]) -> dict[str, str]:
    """Which column of a single foreign table holds id, title, author, year, language, place: the first whose name fits."""
    wanted = {"id": ("id",), "title": ("title",), "author": ("author", "creator"), "year": ("year", "date"), "language": ("lang",), "place": ("place",)}
    out: dict[str, str] = {}
    for field, parts in wanted.items():
        for part in parts:
            hit = next((c for c in columns if part in c.lower() and c not in out.values()), None)
            if hit:
                out[field] = hit
                break
    return out


def single_table(df: DataFrame) -> DataFrame:
    """id, title, author, year, language, place of a foreign table by guessed columns; years from any of its year columns."""
    found = guess_columns(df.columns)
    years = [c for c in df.columns if "year" in c.lower() or "date" in c.lower()]
    year = F.coalesce(*[year_of_edition(F.col(c).cast("string")) for c in years]) if years else F.lit(None).cast("int")
    text = {f: fold(F.col(c).cast("string")) if (c := found.get(f)) else F.lit(None).cast("string") for f in ("id", "title", "author", "language", "place")}
    return df.select(*[c.alias(n) for n, c in text.items()], year.alias("year"))


def display_names(actors: DataFrame, order: str = ROW) -> DataFrame:
    """iri, name: the actor's name, else first and last; of repeated IRIs the last named row counts."""
    iri = F.regexp_replace(fold("actor"), "^<|>$", "")
    name = F.coalesce(fold("actor_name"), F.nullif(F.concat_ws(" ", fold("actor_first_name"), fold("actor_last_name")), F.lit("")))
    d = actors.select(iri.alias("iri"), name.alias("name"), order).where("iri IS NOT NULL AND name IS NOT NULL")
    return last_row_by(d, ["iri"], order).select("iri", "name")


def edition_authors(editions: DataFrame, names: DataFrame, key: str = "edition", cell: str = "author", bare: str = "author_name") -> DataFrame:
    """key, iri, name: every IRI in the cell with its display name, and a bare name with an empty IRI."""
    d = editions.select(F.col(key), F.explode(F.regexp_extract_all(cell, F.lit("<([^>]+)>"), F.lit(1))).alias("iri"))
    out = d.join(names, "iri", "left").select(key, "iri", "name")
    if bare in editions.columns:
        more = editions.select(F.col(key), F.lit("").alias("iri"), fold(bare).alias("name")).where("name IS NOT NULL")
        out = out.unionByName(more)
    return out


def canonical(df: DataFrame, column: str, mapping: DataFrame, actor: str = "actor", to: str = "canonical_actor") -> DataFrame:
    """df with identifiers replaced by their canonical ones; those without a mapping stay."""
    m = mapping.groupBy(F.col(actor).alias("_a")).agg(F.min(to).alias("_c"))
    return df.join(m, df[column] == F.col("_a"), "left").withColumn(column, F.coalesce("_c", column)).select(*df.columns)


def inherit(known: DataFrame, mapping: DataFrame) -> DataFrame:
    """known (actor, other_actor) and, for duplicates that have no link of their own, the link of their canonical actor."""
    more = mapping.join(known.select(F.col("actor").alias("canonical_actor"), "other_actor"), "canonical_actor").select("actor", "other_actor")
    return known.unionByName(more.join(known, "actor", "left_anti"))


def persons(df: DataFrame, key: str = "actor_id", flag: str = "is_organization") -> DataFrame:
    """Rows with an identifier that aren't marked as organisations."""
    return df.where(fold(key).isNotNull() & (F.coalesce(F.upper(fold(flag)), F.lit("")) != "TRUE"))
