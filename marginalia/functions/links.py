"""Link extraction from wikitext as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a link is, and which links have no target at all.
LINK = r"\[\[(.+?)\]\]"
NO_TARGET = r"^(#+|\|+(#.*)?)$"
NAMESPACE_MARK = ":"


def link_bodies(text: Column) -> Column:
    """What stands between ``[[`` and ``]]``, in page order; a link never spans lines.

    An opening mark without an end takes the rest of its line as an empty find: no mark behind
    it can have an end either, and none is searched for again.
    """
    found = F.regexp_extract_all(text, F.lit(LINK + r"|\[\[.*"), 1)
    return F.filter(found, lambda body: body != "")


def link_target(body: Column) -> Column:
    return F.substring_index(F.substring_index(body, "#", 1), "|", 1)


def page_links(title: Column, text: Column, drop_empty: bool = False) -> Column:
    """``array<struct<src,dst>>`` of a page: duplicates, case, blanks and self links kept.

    Links with a namespace mark anywhere, and links made only of separators, are left out.
    ``[[#section]]`` yields an empty target unless ``drop_empty`` is set.
    """
    kept = F.filter(
        link_bodies(text),
        lambda body: ~body.contains(NAMESPACE_MARK) & ~body.rlike(NO_TARGET),
    )
    links = F.transform(kept, lambda body: F.struct(title.alias("src"), link_target(body).alias("dst")))
    if drop_empty:
        links = F.filter(links, lambda link: link["dst"] != "")
    nothing = F.array().cast("array<struct<src:string,dst:string>>")
    return F.when(title.isNull() | text.isNull(), nothing).otherwise(links)
