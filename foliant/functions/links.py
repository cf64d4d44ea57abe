"""External links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.nulls import col

#: Hosts of known authorities and their names; hosts that moved to https.
AUTHORITIES = {
    "viaf.org": "VIAF",
    "wikidata.org": "Wikidata",
    "isni.org": "ISNI",
    "id.loc.gov": "LC Name Authority",
    "d-nb.info": "DNB (GND)",
    "www.idref.fr": "IdRef",
    "datos.bne.es": "BNE",
    "fr.wikipedia.org": "Wikipedia (fr)",
    "data.biblissima.fr": "Biblissima",
    "fr.dbpedia.org": "DBpedia (fr)",
    "imslp.org": "IMSLP",
    "francearchives.gouv.fr": "FranceArchives",
    "musicbrainz.org": "MusicBrainz",
    "www.persee.fr": "Persee",
    "data.persee.fr": "Persee (data)",
    "sws.geonames.org": "GeoNames",
    "www.insee.fr": "INSEE",
    "www.siv.archives-nationales.culture.gouv.fr": "Archives Nationales",
    "www.pop.culture.gouv.fr": "POP (Culture)",
    "aims.fao.org": "FAO AIMS",
    "purl.org": "PURL",
    "orcid.org": "ORCID",
}
SECURE = ("fr.wikipedia.org", "imslp.org")
URI = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)(.*)\z"


def unwrap(c: Column | str) -> Column:
    """Without the angle brackets around an IRI, if both stand."""
    c = col(c)
    return F.when(c.startswith("<") & c.endswith(">"), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def link_parts(c: Column | str) -> dict[str, Column]:
    """harmonised, authority, correction_type, confidence of a folded link: scheme and host in lower case, known hosts named."""
    c = col(c)
    inner = unwrap(c)
    scheme, host, rest = F.lower(F.regexp_extract(inner, URI, 1)), F.lower(F.regexp_extract(inner, URI, 2)), F.regexp_extract(inner, URI, 3)
    authority = F.create_map(*[F.lit(x) for kv in AUTHORITIES.items() for x in kv])[host]
    kind = (
        F.when(c.isNull(), "missing")
        .when((scheme == "") | (host == ""), "malformed")
        .when(host.isin(*SECURE) & (scheme == "http"), "scheme_upgraded_https")
        .when(authority.isNotNull(), "passthrough")
        .otherwise("unknown_authority")
    )
    good = ~kind.isin("missing", "malformed")
    return {
        "harmonised": F.when(good, F.concat(F.when(kind == "scheme_upgraded_https", "https").otherwise(scheme), F.lit("://"), host, rest)),
        "authority": F.when(good, authority),
        "correction_type": kind,
        "confidence": F.when(~good, "low").when(kind == "unknown_authority", "medium").otherwise("high"),
    }
