"""Names, labels and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data formats.
NAME_PREFIX = "hCoV-19/"
INNER_PREFIX = "NODE_"
#: A numbered subtree of a family: its parent's name is the first group.
SUBTREE = r"^(rdrp-[a-z]+-xs)_(\d+)$"
PUBLISH_ROOT = "trajectories"
FORBIDDEN_IN_FILES = r'[/\\:*?"<>| ]'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c) -> Column:
    """A node name without the leading `hCoV-19/`."""
    return F.regexp_replace(_col(c), "^" + NAME_PREFIX, "")


def is_tip_name(c) -> Column:
    """True for names of tips; null stays null."""
    return ~F.startswith(clean_name(c), F.lit(INNER_PREFIX))


def file_stem(c) -> Column:
    """A name as file name: a leading `hCoV-19` goes, then every character that files may not carry."""
    return F.regexp_replace(F.regexp_replace(_col(c), "^hCoV-19", ""), FORBIDDEN_IN_FILES, "")


def label(c) -> Column:
    """A label without surrounding blanks, in upper case."""
    return F.upper(F.regexp_replace(_col(c), r"^\s+|\s+$", ""))


def split_of(c) -> Column:
    """A split label without blanks, in lower case; blank and null mean train."""
    low = F.lower(F.regexp_replace(_col(c), r"\s+", ""))
    return F.when(F.length(low) > 0, low).otherwise(F.lit("train"))


def publish_prefix(analysis, prefix: str = PUBLISH_ROOT) -> Column:
    """Where an analysis is published: numbered subtrees of a family nest below their parent, under their whole name."""
    name = _col(analysis)
    nested = F.concat_ws("/", F.lit(prefix), F.regexp_extract(name, SUBTREE, 1), F.lit("subtrees"), name)
    return F.when(F.regexp_like(name, F.lit(SUBTREE)), nested).otherwise(F.concat_ws("/", F.lit(prefix), name))
