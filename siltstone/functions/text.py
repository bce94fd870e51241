"""Scalar rules as column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a text.
SPACE = r"[\s\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ISO = r"^\d{4}-\d{2}-\d{2}([T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?(Z|[+-](0\d|1[0-4]):[0-5]\d)?)?$"
EPOCH = "1970-01-01T00:00:00Z"


def or_default(c: Column, default: Column) -> Column:
    """default where a text is null or ''."""
    return F.coalesce(F.nullif(c, F.lit("")), default)


def number_or_default(c: Column, default: float) -> Column:
    """default where a number is null or 0."""
    return F.when(c.isNull() | (c == 0), F.lit(default)).otherwise(c)


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def clean_string(c: Column) -> Column:
    """Without control characters and U+FFFD; null becomes ''."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x{FFFD}\x00-\x1F\x7F-\x9F]", "")


def clean_link(c: Column) -> Column:
    """Letters, digits and . / : - _ ~ only."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}./:_~-]", "")


def map_key(c: Column) -> Column:
    return F.lower(strip(c))


def legacy_map_key(c: Column) -> Column:
    return F.lower(c)


def name_identifier(c: Column) -> Column:
    """A person's identifier without its address or prefix, in lower case."""
    s = strip(c)
    at = F.instr(s, "orcid.org/")
    bare = F.when(at > 0, F.substr(s, at + F.lit(10))).when(
        F.lower(s).startswith("orcid:"), F.when(F.instr(s, "orcid:") > 0, F.substr(s, F.instr(s, "orcid:") + F.lit(6))).otherwise(s)
    )
    return F.lower(strip(F.coalesce(bare, s)))


def is_orcid(c: Column) -> Column:
    return c.rlike("^([0-9a-f]{4}-){3}[0-9a-f]{3}[0-9a-fx]$")


def name_identifiers(a: Column) -> Column:
    """Normalised identifiers, blank ones left out, sorted."""
    return F.array_sort(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), name_identifier), lambda x: x.isNotNull() & (x != "")))


def canonical_identifier(ids: Column) -> Column:
    """The first identifier of ORCID's form in sorted ids, else the first; null if there is none."""
    return F.coalesce(F.try_element_at(F.filter(ids, is_orcid), F.lit(1)), F.try_element_at(ids, F.lit(1)))


def strip_parentheses(c: Column) -> Column:
    """Without parentheses around the whole, as long as it opens and closes with one."""
    s = strip(c)
    n = lambda run: F.length(F.regexp_replace(run, r"[^()]", ""))
    k = F.least(n(F.regexp_extract(s, rf"^((?:\({SPACE}*)*)", 1)), n(F.regexp_extract(s, rf"((?:{SPACE}*\))*)$", 1))).cast("string")
    opened = F.regexp_replace(s, F.concat(F.lit(rf"^(?:\({SPACE}*){{"), k, F.lit("}")), F.lit(""))
    both = F.regexp_replace(opened, F.concat(F.lit(rf"(?:{SPACE}*\)){{"), k, F.lit("}$")), F.lit(""))
    return F.when(s.startswith("(") & s.endswith(")"), both).otherwise(s)


def affiliations(a: Column) -> Column:
    """Affiliations without outer parentheses, null and '' left out beforehand, sorted by case."""
    return F.array_sort(F.transform(F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), strip_parentheses))


def organization_key(c: Column, stripped: bool = False) -> Column:
    """An organisation's name without anything in parentheses, in lower case; stripped
    says that strip_parentheses has been applied."""
    return F.lower(strip(F.regexp_replace(c if stripped else strip_parentheses(c), r"\(.*?\)", "")))


def doi_prefix(c: Column) -> Column:
    return F.when(c.startswith("10."), F.substring_index(c, "/", 1))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def topic_full_id(c: Column) -> Column:
    return F.when((c == "ALL") | c.startswith("https://openalex.org/"), c).otherwise(F.concat(F.lit("https://openalex.org/"), c))


def topic_short_id(c: Column) -> Column:
    return F.regexp_replace(c, "^https://openalex.org/", "")


def clean_uri(c: Column) -> Column:
    """The address if it is http or https with a host, else null."""
    s = strip(c)
    return F.when(s.rlike(r"(?i)^https?://[^/?#]+"), s)


def main_identifier(ids: Column) -> Column:
    """Of a list of (identifier, identifier_type) the first doi, else the first."""
    doi = F.try_element_at(F.filter(ids, lambda x: x["identifier_type"] == "doi"), F.lit(1))
    return F.coalesce(doi, F.try_element_at(ids, F.lit(1)))


def iso_timestamp(c: Column) -> Column:
    """The instant of an ISO text, UTC without zone; null if it is none."""
    with_seconds = F.regexp_replace(c, r"^(.{16})(?=$|[Z+-])", "$1:00")
    return F.when(c.rlike(ISO), F.try_to_timestamp(with_seconds))


def iso_timestamp_or(c: Column, default: Column) -> Column:
    return F.coalesce(iso_timestamp(c), default)


def published_at(c: Column) -> Column:
    """As iso_timestamp, offsets beyond 14 hours taken off, the epoch if it is none."""
    wild = r"[+-](1[5-9]|[2-9]\d):?\d{2}$"
    return F.coalesce(iso_timestamp(F.regexp_replace(strip(c), wild, "")), F.lit(EPOCH).cast("timestamp"))


def year_of_text(c: Column) -> Column:
    """The first four characters as a year, whatever the zone."""
    return F.when(F.substring(strip(c), 1, 4).rlike("^[0-9]{4}$"), F.substring(strip(c), 1, 4).cast("int"))


def safe_int(c: Column) -> Column:
    return c.try_cast("int")


def safe_float(c: Column) -> Column:
    return c.try_cast("double")


def clamp_score(c: Column) -> Column:
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))))


def first_two(a: Column) -> Column:
    return F.array_join(F.slice(a, 1, 2), "; ")


def tsv_escape(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\n\r]", " ")


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", c)


def lower_sources(a: Column) -> Column:
    return F.transform(F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: x.isNotNull()), F.lower)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def version_or_estimated(c: Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit("estimated"))


def epoch_seconds(c: Column) -> Column:
    return F.timestamp_seconds(c)


def without_utc_offset(c: Column) -> Column:
    return F.regexp_replace(c, r"\+00:00$", "")
