"""Column functions on storage paths: stamps, containers, subjects, templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the snapshot stamp format and the folder key that carries it
STAMP_FORMAT = "yyyy_MM_dd_HH_mm_ss"
STAMP_PATTERN = r".*(\d{4}_\d{2}_\d{2}_\d{2}_\d{2}_\d{2}).*"
SNAPSHOT_FOLDER = "/snapshot_date"


def snapshot_or_null(path: Column) -> Column:
    """The last stamp in the path, or null."""
    return F.nullif(F.regexp_extract(path, STAMP_PATTERN, 1), F.lit(""))


def snapshot_required(path: Column) -> Column:
    """The last stamp in the path; rows without one fail the query."""
    stamp = snapshot_or_null(path)
    message = F.concat(F.lit("no snapshot stamp in path: "), path)
    return F.coalesce(stamp, F.raise_error(message).cast("string"))


def snapshot_time(stamp: Column) -> Column:
    return F.to_timestamp(stamp, STAMP_FORMAT)


def plain_path(uri: Column) -> Column:
    """The path behind an encoded file URI."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def base_name(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Text after the last dot of the file name, or an empty string."""
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def short_subject(path: Column) -> Column:
    """The path before its snapshot folder."""
    return F.substring_index(path, SNAPSHOT_FOLDER, 1)


def store_account(url: Column) -> Column:
    """Account of ``abfss://container@ACCOUNT.rest/path``, or null."""
    return F.nullif(F.regexp_extract(url, r"abfss://[^@]+@([^./]+)", 1), F.lit(""))


def store_container(url: Column) -> Column:
    """Container of ``abfss://CONTAINER@account/path``, or null."""
    return F.nullif(F.regexp_extract(url, r"abfss://([^@]+)@", 1), F.lit(""))


def blob_container(subject: Column) -> Column:
    """Container of ``/.../containers/CONTAINER/blobs/path``, or null."""
    found = F.regexp_extract(subject, r"containers/(.*?)/blobs", 1)
    return F.when(subject.rlike(r"containers/.*?/blobs"), found)


def store_subject(url: Column, roots: list[str]) -> Column:
    """Drop the first of the given storage roots found in the url, with all before it."""
    cut = url
    for root in reversed(roots):
        cut = F.when(F.contains(url, F.lit(root)), _after(url, root)).otherwise(cut)
    return cut


def blob_subject(subject: Column) -> Column:
    """The path inside the container: all after the first ``blobs``."""
    return _after(subject, "blobs")


def _after(text: Column, marker: str) -> Column:
    at = F.instr(text, marker)
    return F.when(at > 0, F.substring(text, at + F.lit(len(marker)), F.length(text))).otherwise(text)


def fill_template(template: Column, tokens: Column) -> Column:
    """Replace every ``{key}`` by the value the token map holds for it."""
    return F.aggregate(
        F.map_entries(tokens),
        template,
        lambda text, token: F.replace(text, F.concat(F.lit("{"), token["key"], F.lit("}")), token["value"]),
    )


def fill_text(template: str, tokens: dict[str, str]) -> str:
    """``fill_template`` for a name held by a load spec."""
    for key, value in tokens.items():
        template = template.replace("{" + key + "}", value)
    return template


# fixed values: the names of the parameters, the environment without a prefix, and how prefix and folder are made
def environment_parameters(environment: str, line_of_business: str | None = None) -> dict[str, str]:
    """The ``${name}`` parameters a load spec may use."""
    return {
        "environment": environment,
        "hiveDbPrefix": "" if environment == "prod" else f"{environment}_",
        "lineOfBusinessDbPrefix": f"{line_of_business}_" if line_of_business else "",
        "lineOfBusinessDirectory": f"{line_of_business}/" if line_of_business else "",
    }


def fill_parameters(text: str, parameters: dict[str, str]) -> str:
    for key, value in parameters.items():
        text = text.replace("${" + key + "}", value)
    return text
