"""A small mapping language: rules (source, subject, guard, predicates) projected over tables into triples.

Every rule of a source is evaluated in the same scan: a row gives an array of triples, which is then exploded. A rule
applies where its guard column is filled, and gives a triple where subject and object are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Namespaces of public vocabularies. `obj` and `portal` are the application's own; give them at the call.
PREFIXES = {
    "crm": "http://www.cidoc-crm.org/cidoc-crm/",
    "lrmoo": "http://iflastandards.info/ns/lrm/lrmoo/",
    "crmdig": "http://www.ics.forth.gr/isl/CRMdig/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "aat": "http://vocab.getty.edu/aat/",
    "edtf": "http://id.loc.gov/datatypes/edtf/",
    "geo": "http://www.opengis.net/ont/geosparql#",
    "obj": "https://example.org/schema/",
    "portal": "https://example.org/portal/",
}
TYPE = "rdf:type"


@dataclass(frozen=True)
class Rule:
    """predicates: (predicate, object) or (predicate, object, datatype); an object in braces names a column, else it is an IRI."""

    source: str
    subject: str
    guard: str | None
    predicates: tuple[tuple[str, ...], ...] = field(default=())
    equals: str | None = None


def expand(name: str, prefixes: dict[str, str]) -> str:
    head, _, tail = name.partition(":")
    return prefixes[head] + tail if head in prefixes else name


def triples(tables: dict[str, DataFrame], rules: list[Rule], prefixes: dict[str, str] | None = None) -> DataFrame:
    """s, p, o, kind (iri or literal), datatype of all rules; a bag. Missing columns count as empty."""
    names = PREFIXES | (prefixes or {})
    out = None
    for source, df in tables.items():
        have = set(df.columns)

        mine = [(r, p, o, kind) for r in rules if r.source == source for p, o, *kind in r.predicates]
        if not mine:
            continue
        used = sorted({c for r, _, o, _ in mine for c in (r.subject, r.guard, o[1:-1] if o.startswith("{") else None) if c is not None})
        place = {c: i for i, c in enumerate(used)}
        value = [F.nullif(F.col(c).cast("string"), F.lit("")) if c in have else F.lit(None).cast("string") for c in used]
        # The rules as a constant array that names columns by place: one small expression, however many rules there are.
        rows = [
            F.struct(
                F.lit(place.get(r.guard)).cast("int").alias("guard"), F.lit(expand(r.equals, names) if r.equals else None).cast("string").alias("equals"),
                F.lit(place[r.subject]).alias("s"), F.lit(place.get(o[1:-1])).cast("int").alias("column"), F.lit(None if o.startswith("{") else expand(o, names)).cast("string").alias("o"),
                F.lit(expand(p, names)).alias("p"), F.lit("literal" if kind else "iri").alias("kind"), F.lit(expand(kind[0], names) if kind else None).cast("string").alias("datatype"),
            )
            for r, p, o, kind in mine
        ]
        v = F.col("_values")
        made = F.transform(F.array(*rows), lambda r, i: F.struct(r.alias("r"), F.get(v, r["s"]).alias("s"), F.coalesce(r["o"], F.get(v, r["column"])).alias("o"), i.alias("rule")))
        holds = lambda t: t["r"]["guard"].isNull() | F.coalesce(F.get(v, t["r"]["guard"]) == F.coalesce(t["r"]["equals"], F.get(v, t["r"]["guard"])), F.lit(False))
        full = F.filter(made, lambda t: t["s"].isNotNull() & t["o"].isNotNull() & holds(t))
        part = df.select(F.array(*value).alias("_values")).select(F.inline(F.transform(full, lambda t: F.struct(t["s"], t["o"], t["rule"]))))
        part = part.select("s", F.get(F.array(*rows), F.col("rule")).alias("r"), "o").select("s", "r.p", "o", "r.kind", "r.datatype")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no rule applies to the tables given")
    return out


def as_graph(t: DataFrame) -> DataFrame:
    """Triples as a set."""
    return t.distinct()


# Rules. Groups that differ in a name only are made by functions.


def _appellation(source: str, owner: str, node: str, column: str, kind: str | None, link: str = "obj:isIdentifiedBy") -> list[Rule]:
    typed = () if kind is None else (("obj:hasType", kind),)
    return [
        Rule(source, node, column, ((TYPE, "obj:Appellation"), *typed, ("obj:hasSymbolicContent", f"{{{column}}}", "xsd:string"))),
        Rule(source, owner, column, ((link, f"{{{node}}}"),)),
    ]


def _event(name: str, kind: str) -> list[Rule]:
    guard = f"actor_{name}_obj"
    return [
        Rule("actors", f"actor_{name}_event", guard, ((TYPE, "obj:Event"), ("obj:hasType", f"obj:{kind}"), ("obj:hasTimeSpan", f"{{actor_{name}_ts}}"))),
        Rule("actors", f"actor_{name}_ts", guard, ((TYPE, "obj:Time-Span"), ("obj:hasStartTime", f"{{{guard}}}", "xsd:dateTime"), ("obj:hasEndTime", f"{{{guard}}}", "xsd:dateTime"))),
        Rule("actors", "actor", guard, (("obj:wasPresentAt", f"{{actor_{name}_event}}"),)),
    ]


def _assignment(name: str, column: str) -> list[Rule]:
    return [Rule("actors", f"actor_{name}_aa", column, ((TYPE, "obj:AttributeAssignment"), ("obj:assignsAttributeTo", "{actor}"), ("obj:assignsPropertyOfType", f"obj:{name}"), ("obj:assigns", f"{{{column}}}")))]


def _link_table(source: str, column: str) -> list[Rule]:
    return [
        Rule(source, column, column, ((TYPE, "obj:Identifier"), ("obj:hasType", "obj:uri"), ("obj:hasSymbolicContent", f"{{{column}}}", "xsd:anyURI"))),
        Rule(source, "actor", column, (("obj:isIdentifiedBy", f"{{{column}}}"),)),
    ]


def actor_rules() -> list[Rule]:
    """Rules over actors, links_exact and links_close."""
    out = [
        Rule("actors", "actor_if_person", "entity_type", ((TYPE, "obj:Person"),), equals="obj:Person"),
        Rule("actors", "actor_if_organization", "entity_type", ((TYPE, "obj:Organization"),), equals="obj:Organization"),
    ]
    for part, column in (("full", "actor_name"), ("first", "actor_first_name"), ("last", "actor_last_name")):
        out += _appellation("actors", "actor", f"actor_app_{part}name", column, f"obj:{part}-name")
    out += _assignment("gender", "actor_gender_obj") + _assignment("language", "actor_language")
    for name, kind in (("birth", "birth"), ("death", "death"), ("start", "foundation"), ("end", "dissolution")):
        out += _event(name, kind)
    out += [
        Rule("actors", "actor", "actor_country", (("obj:hasResidenceIn", "{actor_country}"),)),
        Rule("actors", "actor_country", "actor_country", ((TYPE, "obj:Place"),)),
        Rule("actors", "actor_profession_lo", "actor_profession", ((TYPE, "obj:LinguisticObject"), ("obj:hasType", "obj:description"), ("obj:hasSymbolicContent", "{actor_profession}", "xsd:string"))),
        Rule("actors", "actor", "actor_profession", (("obj:isReferredToBy", "{actor_profession_lo}"),)),
    ]
    out += _link_table("links_exact", "actor_link_exact") + _link_table("links_close", "actor_link_close")
    for column, p in (("viaf_uri", "owl:sameAs"), ("wikidata_uri", "owl:sameAs"), ("isni_uri", "rdfs:seeAlso"), ("lc_uri", "rdfs:seeAlso")):
        out.append(Rule("actors", "actor", column, ((p, f"{{{column}}}"),)))
    return out


#: Vocabulary terms of the roles.
ROLE_TERMS = {"author": "aat:300025492", "editor": "aat:300312355", "translator": "aat:300069831", "illustrator": "aat:300025164"}


def edition_rules() -> list[Rule]:
    """Rules over editions."""
    e = "editions"
    out = [
        Rule(e, "edition", None, ((TYPE, "lrmoo:F3_Manifestation"),)),
        Rule(e, "edition", "record_type", (("obj:hasType", "{record_type}"),)),
        Rule(e, "edition_bnf_id", "bnf_id", ((TYPE, "obj:Identifier"), ("obj:hasType", "aat:300404621"), ("obj:hasSymbolicContent", "{bnf_id}", "xsd:string"))),
        Rule(e, "edition", "bnf_id", (("obj:isIdentifiedBy", "{edition_bnf_id}"),)),
        Rule(e, "edition_title", "title", ((TYPE, "crm:E35_Title"), ("obj:hasType", "aat:300417204"), ("obj:hasSymbolicContent", "{title}", "xsd:string"))),
        Rule(e, "work", "title", (("crm:P102_has_title", "{edition_title}"),)),
        Rule(e, "edition", "title", (("crm:P102_has_title", "{edition_title}"),)),
        Rule(e, "edition_ts_year_first", "year_first", ((TYPE, "obj:Time-Span"), ("crm:P82a_begin_of_the_begin", "{year_first}", "edtf:EDTF"), ("crm:P82b_end_of_the_end", "{year_first}", "edtf:EDTF"))),
        Rule(e, "edition", "year_first", (("obj:hasTimeSpan", "{edition_ts_year_first}"),)),
        Rule(e, "edition_ts_year_range", "year_range", ((TYPE, "obj:Time-Span"), ("crm:P82_at_some_time_within", "{year_range}", "edtf:EDTF"))),
        Rule(e, "edition", "year_range", (("obj:hasTimeSpan", "{edition_ts_year_range}"),)),
        Rule(e, "edition", "description", (("crm:P3_has_note", "{description}", "xsd:string"),)),
    ]
    for node, kind, raw, clean, link in (("edition_pub_place", "obj:Place", "place", "publication_place", "crm:P7_took_place_at"), ("edition_pub_actor", "obj:Actor", "publisher", "publisher_harmonised", "crm:P14_carried_out_by")):
        for column, app, typed in ((raw, f"{node}_app", ()), (clean, f"{node}_norm_app", (("obj:hasType", "aat:300404670"),))):
            out += [
                Rule(e, node, column, ((TYPE, kind), ("obj:isIdentifiedBy", f"{{{app}}}"))),
                Rule(e, app, column, ((TYPE, "obj:Appellation"), *typed, ("obj:hasSymbolicContent", f"{{{column}}}", "xsd:string"))),
                Rule(e, "edition", column, ((link, f"{{{node}}}"),)),
            ]
    out += [
        Rule(e, "edition_pub_place", "place_wkt", (("crm:P168_place_is_defined_by", "{place_wkt}", "geo:wktLiteral"),)),
        Rule(e, "edition", "publisher_2", (("crm:P14_carried_out_by", "{publisher_2}"),)),
        Rule(e, "expression", "expression", ((TYPE, "lrmoo:F2_Expression"),)),
        Rule(e, "edition", "expression", (("lrmoo:R4_embodies", "{expression}"),)),
        Rule(e, "expression", "language", (("crm:P72_has_language", "{language}"),)),
        Rule(e, "work", "work", ((TYPE, "lrmoo:F1_Work"),)),
        Rule(e, "expression", "work", (("lrmoo:R3i_realises", "{work}"),)),
        Rule(e, "edition_digital_obj", "digital_copy_link", ((TYPE, "crmdig:D9_Data_Object"), ("obj:isIdentifiedBy", "{edition_digital_id}"))),
        Rule(e, "edition_digital_id", "digital_copy_link", ((TYPE, "obj:Identifier"), ("obj:hasType", "aat:300404630"), ("obj:hasSymbolicContent", "{digital_copy_link}", "xsd:anyURI"))),
        Rule(e, "edition", "digital_copy_link", (("crm:P130i_features_are_also_found_on", "{edition_digital_obj}"),)),
        Rule(e, "subject_topic", "subject_topic", ((TYPE, "crm:E73_Information_Object"), ("obj:hasType", "aat:300404126"))),
        Rule(e, "expression", "subject_topic", (("crm:P129_is_about", "{subject_topic}"),)),
        Rule(e, "edition_expr_creation", None, ((TYPE, "lrmoo:F28_Expression_Creation"), ("lrmoo:R17_created", "{expression}"))),
        Rule(e, "edition", None, (("crm:P16i_was_used_for", "{edition_expr_creation}"),)),
    ]
    for role, term in ROLE_TERMS.items():
        node = f"edition_expr_creation_{role}"
        out += [
            Rule(e, node, role, ((TYPE, "crm:E7_Activity"), ("obj:hasType", term), ("crm:P14_carried_out_by", f"{{{role}}}"))),
            Rule(e, "edition_expr_creation", role, (("crm:P9_consists_of", f"{{{node}}}"),)),
        ]
    out.append(Rule(e, "edition", "estc_uri", (("rdfs:seeAlso", "{estc_uri}"),)))
    return out


def role_rules() -> list[Rule]:
    """Rules over roles."""
    r = "roles"
    return [
        Rule(r, "edition_expr_creation", "edition_expr_creation", ((TYPE, "lrmoo:F28_Expression_Creation"),)),
        Rule(r, "edition_iri", "edition_expr_creation", (("crm:P16i_was_used_for", "{edition_expr_creation}"),)),
        Rule(r, "role_activity_iri", "role_aat", ((TYPE, "crm:E7_Activity"), ("obj:hasType", "{role_aat}"), ("crm:P14_carried_out_by", "{actor_iri}"))),
        Rule(r, "edition_expr_creation", "role_aat", (("crm:P9_consists_of", "{role_activity_iri}"),)),
    ]
