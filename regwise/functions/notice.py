"""Reading of notice titles, sources and attachments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regwise import rules as R
from regwise.functions.text import clean_title, core, strip


def publisher_of(title: Column) -> Column:
    """Agency that opens the title, blank when the title names none."""
    return F.regexp_extract(clean_title(title), "(?U)" + R.PUBLISHER, 1)


def stage_of(title: Column) -> Column:
    stage = F.when(F.lit(False), "")
    for name, pattern in R.STAGE_PATTERNS:
        stage = stage.when(title.rlike(pattern), name)
    return stage.otherwise("")


def keeps_stage(declared: Column, title: Column) -> Column:
    """Stage under which a notice of a channel counts, null when it is left out.

    A channel declared for one stage takes unlabelled titles too; a mixed
    channel relies on the title.
    """
    stage = stage_of(title)
    mixed = declared == R.MIXED_STAGE
    return F.when(mixed, F.nullif(stage, F.lit(""))).when((stage == "") | (stage == declared), declared)


def bracket_of(title: Column) -> Column:
    return strip(F.regexp_extract(F.coalesce(title, F.lit("")), "(?U)" + R.BRACKET, 1))


def parse_source(text: Column) -> Column:
    """Publishing agency named after the source label of a page text."""
    named = F.regexp_extract(F.coalesce(text, F.lit("")), "(?U)" + R.SOURCE, 1)
    return strip(F.get(F.split(named, R.SOURCE_TAIL), F.lit(0)))


def is_radiation(title: Column, bracket: Column | None = None) -> Column:
    hit = F.coalesce(title, F.lit("")).rlike(R.RADIATION)
    return hit if bracket is None else hit | F.coalesce(bracket, F.lit("")).rlike(R.RADIATION)


def bracket_meaning(bracket: Column, radiation: Column, bracket_district: Column,
                    approval_district: Column) -> Column:
    """What the closing bracket of a title stands for; radiation is decided first."""
    category, level, doctype, none, no_place, publisher, project = R.BRACKET_MEANINGS
    return (F.when(radiation, category)
            .when(core(bracket).isin(*R.LEVEL_WORDS) | bracket.isin(*R.LEVEL_WORDS), level)
            .when(bracket.rlike(R.DOCUMENT_TYPE), doctype)
            .when(bracket == "", none)
            .when(F.coalesce(bracket_district, F.lit("")) == "", no_place)
            .when(approval_district == bracket_district, publisher)
            .otherwise(project))


def is_report(label: Column, size: Column, pages: Column) -> Column:
    """Whether an attachment is the report itself; unnamed ones need size and pages."""
    strong = label.rlike(R.REPORT)
    by_size = (size >= R.BIG_FILE) & (pages.isNull() | (pages >= R.MIN_PAGES))
    return (F.when(label.rlike(R.DECISION) | label.rlike(R.SIDE_MATERIAL), False)
            .when(label.rlike(R.PARTICIPATION) & ~strong, False)
            .when(strong | label.rlike(R.NAMED_FILE), True)
            .otherwise(F.coalesce(by_size, F.lit(False))))


def attachment_label(text: Column, title: Column, href: Column) -> Column:
    """Anchor text, title attribute and decoded file name in one line."""
    file_name = F.regexp_extract(href, "([^/]*)$", 1)
    decoded = F.coalesce(F.try_url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B"))), file_name)
    return F.concat(text, F.lit(" "), F.coalesce(title, F.lit("")), F.lit(" "), decoded)


def is_attachment(href: Column, label: Column) -> Column:
    return href.rlike(R.ATTACHMENT_EXT) | label.rlike(R.ATTACHMENT_EXT)


def field_of(label: Column) -> Column:
    """Canonical field of a table label, blank for other labels."""
    field = F.when(F.lit(False), "")
    for name, synonyms in R.FIELD_SYNONYMS.items():
        field = field.when(label.isin(*synonyms), name)
    return field.otherwise("")
