"""Names from URIs and model identifiers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_name(uri: Column) -> Column:
    """The part after the last `#`; without one, after the last `/`; else the whole."""
    return F.when(F.contains(uri, F.lit("#")), F.substring_index(uri, "#", -1)).otherwise(F.substring_index(uri, "/", -1))


def namespace(uri: Column) -> Column:
    """The part up to the last `#`, else up to the last `/`, with the separator; empty if neither."""
    return F.when(F.contains(uri, F.lit("#")), F.regexp_extract(uri, "^(?s)(.*#)", 1)).otherwise(F.regexp_extract(uri, "^(?s)(.*/)", 1))


def sanitize(name: Column, *, prefix: str = "E_", most: int | None = 128, empty: Column | str = "Entity") -> Column:
    """Letters, digits and underscores only (Unicode); `prefix` before a first character that is no letter; cut at `most`."""
    clean = F.regexp_replace(name, r"[^\p{L}\p{N}_]", "_")
    led = F.when(clean.rlike(r"^\p{L}"), clean).otherwise(F.concat(F.lit(prefix), clean))
    cut = F.substring(led, 1, most) if most else led
    return F.when(F.coalesce(name, F.lit("")) == "", empty if isinstance(empty, Column) else F.lit(empty)).otherwise(cut)


def uri_name(uri: Column, unknown: Column | str = "Unknown") -> Column:
    """A sanitised local name; `unknown` for an empty one."""
    return sanitize(local_name(uri), empty=unknown)


def model_name(name: Column) -> Column:
    """Sanitised names of digital-twin models: 90 characters."""
    return sanitize(name, most=90)


def service_name(name: Column) -> Column:
    """Display names of a whole ontology."""
    return sanitize(name, prefix="O_", most=90, empty="Ontology")


def ontology_name(label: Column) -> Column:
    return sanitize(label, prefix="O_", most=100, empty="ImportedOntology")


def export_name(name: Column) -> Column:
    return sanitize(name, prefix="C_", most=None, empty="UnnamedClass")


def decimal_name(name: Column) -> Column:
    return sanitize(name, prefix="p_", most=None, empty="property")


def is_valid_name(name: Column, most: int = 128) -> Column:
    """A letter, then letters, digits and underscores, at most `most` characters."""
    return F.coalesce(name.rlike(r"^\p{L}[\p{L}\p{N}_]*$") & (F.length(name) <= most), F.lit(False))


def path_tail(path: Column) -> Column:
    """The entity that a document path names: its last segment."""
    return F.substring_index(path, "/", -1)


DTMI = r"^dtmi:[A-Za-z](?:[A-Za-z0-9_]*[A-Za-z0-9])?(?::[A-Za-z](?:[A-Za-z0-9_]*[A-Za-z0-9])?)*(?:;[1-9][0-9]{0,8}(?:\.[1-9][0-9]{0,5})?)?$"


def dtmi_name(dtmi: Column) -> Column:
    """The last segment of a model identifier, without version."""
    return F.substring_index(F.substring_index(dtmi, ";", 1), ":", -1)


def dtmi_faults(dtmi: Column, most: int = 128) -> Column:
    """The first of: bad syntax, too long, reserved prefix; null if there is none."""
    return (
        F.when(~F.coalesce(dtmi, F.lit("")).rlike(DTMI), "syntax")
        .when(F.length(dtmi) > most, "length")
        .when(F.startswith(dtmi, F.lit("dtmi:dtdl:")) | F.startswith(dtmi, F.lit("dtmi:standard:")), "reserved")
    )


def display_name(names: Column, dtmi: Column) -> Column:
    """English, else the first of a language map (`map<string,string>`); else the identifier's name."""
    first = F.get(F.map_values(names), F.lit(0))
    return F.coalesce(F.try_element_at(names, F.lit("en")), first, dtmi_name(dtmi))
