"""Wikitext cleaning as column expressions, one function per step, applied in a fixed order.

Only ``tag_mode="compat"`` runs Python; everything else stays inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The cleaning patterns, as Java regular expressions.
MOVE_INFO = r"(\[\[.*?\]\]).*?\(\[.*?\]\)"
HEADER = r"=+\h*(.*)\h=+"
QUOTES = r"'{2,3}"
DATE = r"\{\{Date.*?\|(.*?)\}\}"
TEMPLATE = r"\{\{[^{}]*\}\}"
ESCAPED_REF = r"&lt;ref&gt;.*?&lt;\/ref&gt;"
LINK_PARENTHESIS = r"(\[\[[^\]]*?)\([^\]]*?\)(.*?\]\])"
LINK_LABEL = r"\[\[[^\]]+?\|(.+?)\]\]"
NAMESPACED_LINK = r"\[\[[^\]]*?:[^\]]*?\]\]"
LINK = r"\[\[(.+?)\]\]"
PUNCTUATION = r"[,;:(|)]"
BLANKS = r" {2,}"
TEMPLATE_ROUNDS = 11

# The same patterns for pages where they find an opening mark again and again but never its end.
# Each part that cannot do better by trying on is atomic or possessive. Where an opening mark
# finds no end, neither can those behind it, up to where the last alternative stops: it takes
# that stretch as it is, so nothing is looked at twice. The last group puts it back.
LINEAR_MOVE_INFO = r"(\[\[(?>.*?\]\]))(?>.*?\(\[)(?>.*?\]\))|(\[\[.*)"
LINEAR_HEADER = r"=.*\h=+|(=.*)"
LINEAR_DATE = r"\{\{Date(?>.*?\|)(.*?)\}\}|(\{\{Date.*)"
LINEAR_ESCAPED_REF = ESCAPED_REF + r"|(&lt;ref&gt;.*)"
LINEAR_NAMESPACED_LINK = r"\[\[[^\]:]*+:[^\]]*+\]\]|(\[\[[^\]]*+)"
LINEAR_LINK = LINK + r"|(\[\[.*)"
# [^\]] passes ends of lines, which the dot does not. Where a link goes on over lines, only its last
# line can hold the mark that the dot follows, so all before that line is passed over as a whole. If
# the mark is there but "]]" does not follow on its line, all up to the last "]" of it is hopeless.
LINE_END = r"[\n\r\x{85}\x{2028}\x{2029}]"
TO_LAST_LINE = rf"(?>[^\]]*{LINE_END})?+"
OTHER = r"[^\]%s\n\r\x{85}\x{2028}\x{2029}]*+"
_PARENTHESIS = rf"\({TO_LAST_LINE}{OTHER % ')'}\)"
LINEAR_LINK_PARENTHESIS = rf"(\[\[[^\](]*+){_PARENTHESIS}(.*?\]\])|(\[\[[^\](]*+{_PARENTHESIS}.*\])|(\[\[[^\]]*+)"
_LABEL = rf"[^\]]{TO_LAST_LINE}{OTHER % '|'}\|"
LINEAR_LINK_LABEL = rf"(\[\[){_LABEL}(.+?\]\])|(\[\[{_LABEL}.*\])|(\[\[[^\]]*+)"


def _from(mark: str, pattern: str) -> str:
    """The pattern, tried only where the mark stands that all its alternatives begin with: at any other
    place one look fails, not each alternative in turn."""
    return rf"(?={mark})(?:{pattern})"


def _let(name: str, value: str, body: str) -> str:
    """The body with the value worked out once, however often it is named in it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _packed(high: str, low: str) -> str:
    """Two numbers in one, in the order of the first."""
    return f"(shiftleft(CAST({high} AS BIGINT), 32) | {low})"


def _high(pair: str) -> str:
    return f"CAST(shiftright({pair}, 32) AS INT)"


def _low(pair: str) -> str:
    return f"CAST({pair} & 4294967295 AS INT)"


STATE, NONE = "held.state", "CAST(array() AS ARRAY<BIGINT>)"


def _scan(items: str, start: str, step: str, when: str, found: str) -> str:
    """Walk over an array with a state (``STATE``), from ``start`` on by ``step`` for each ``item``;
    the numbers ``found`` at the items where ``when`` holds come as an array.

    The state is copied at each step, and all that is found with it. So the walk goes by blocks of as
    many items as there are blocks, and within a block only what is found there is copied.
    """
    one = f"struct({step} AS state, concat(held.found, CASE WHEN {when} THEN array({found}) ELSE {NONE} END) AS found)"
    within = f"aggregate(some, struct(before.state AS state, {NONE} AS found), (held, item) -> {one})"
    block = f"(before, some) -> {_let('w', within, 'struct(w.state AS state, concat(before.found, w.found) AS found)')}"
    cut = _let("n", "CAST(greatest(ceil(sqrt(size(every))), 1) AS INT)", "transform(sequence(1, greatest(size(every), 1), n), at -> slice(every, at, n))")
    return f"aggregate({_let('every', items, cut)}, struct({start} AS state, {NONE} AS found), {block}, end -> end.found)"


def _closed_tags() -> str:
    """In order, those of ``parts`` that end in a tag whose label a later part closes, each packed
    with the first part that does.

    Tags and ends of tags are sorted by label and from the last to the first, so that a walk over
    them always has the end at hand that comes next in the text.
    """
    whole = "slice(parts, 1, size(parts) - 1)"
    opening = f"""filter(transform({whole}, (part, at) ->
      named_struct('label', CASE WHEN contains(part, '<') THEN substr(part, instr(part, '<') + 1) END, 'back', -at, 'ends', false)),
      tag -> tag.label IS NOT NULL)"""
    # What may stand behind an end mark: as many as there are marks, or as there are lengths of labels.
    behind = "transform(sequence(1, marks), k -> substring_index(part, '</', -k))"
    fitting = """transform(filter(transform(filter(lengths, k -> k + 2 <= length(part)), k -> right(part, k + 2)),
      tail -> startswith(tail, '</')), tail -> substr(tail, 3))"""
    labels = _let(
        "marks",
        "CAST((length(part) - length(replace(part, '</', ''))) / 2 AS INT)",
        f"CASE WHEN marks <= size(lengths) THEN {behind} ELSE {fitting} END",
    )
    labels = f"CASE WHEN contains(part, '</') THEN {labels} ELSE CAST(array() AS ARRAY<STRING>) END"
    ends = f"flatten(transform({whole}, (part, at) -> transform({labels}, label -> named_struct('label', label, 'back', -at, 'ends', true))))"
    lengths = "array_distinct(transform(tags, tag -> length(tag.label)))"
    both = f"sort_array({_let('tags', opening, f'concat(tags, {_let("lengths", lengths, ends)})')})"
    pairs = _scan(
        both,
        "named_struct('label', CAST(NULL AS STRING), 'at', 0)",
        f"CASE WHEN item.ends THEN named_struct('label', item.label, 'at', -item.back) ELSE {STATE} END",
        f"NOT item.ends AND item.label = {STATE}.label",
        _packed("-item.back", f"{STATE}.at"),
    )
    return f"sort_array({pairs})"


def _without_tags() -> str:
    """``page`` cut once at all ends of tags: a part leaves what stands before its tag, and one walk
    over the tags that are closed later leaves out the parts between."""
    left = """transform(parts, (part, at) -> CASE WHEN at = size(parts) - 1 THEN part
      WHEN contains(part, '<') THEN substring_index(part, '<', 1) ELSE concat(part, '>') END)"""
    # As if the last part, which ends no tag, were one: it gives the parts behind the last pair.
    last = f"array({_packed('size(parts) - 1', '(size(parts) - 1)')})"
    runs = _scan(
        f"concat({_closed_tags()}, {last})",
        "0",
        f"CASE WHEN {_high('item')} >= {STATE} THEN {_low('item')} + 1 ELSE {STATE} END",
        f"{_high('item')} >= {STATE}",
        _packed(STATE, f"({_high('item')} - {STATE} + 1)"),
    )
    kept = f"array_join(flatten(transform({runs}, run -> slice(pieces, {_high('run')} + 1, {_low('run')}))), '')"
    return f"page -> {_let('parts', "split(page, '>')", _let('pieces', left, kept))}"


WITHOUT_TAGS = _without_tags()


def strip_tags(text: Column) -> Column:
    """Drop tags, and the content of a tag whose exact label is closed later on.

    A lazy search for the closing tag from every open tag is quadratic on pages full of unpaired
    tags, so pages with closing tags are walked over instead.
    """
    walked = F.element_at(F.call_function("transform", F.array(text), F.expr(WITHOUT_TAGS)), 1)
    open_only = F.regexp_replace(text, r"(?s)<[^>]*+>|(<.*)", "$1")
    return F.when(text.contains("</"), walked).otherwise(open_only)


def _as_units(text: str) -> str:
    """One character per UTF-16 unit, surrogate pairs taken apart."""
    units = memoryview(text.encode("utf-16-le")).cast("H")
    return "".join(map(chr, units))


def _from_units(units: str) -> str:
    """Pairs put together again; a half that lost its other half becomes a question mark."""
    text = units.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "surrogatepass")
    return re.sub("[\ud800-\udfff]", "?", text)


def _cut_tags(text: str) -> str:
    """Tag removal that takes one more character on each side of the tag, and gives up on
    the first tag it cannot delete (at the very start, or with nothing behind its end)."""
    kept: list[str] = []
    next_at: dict[str, int] = {}
    at = 0

    def find(needle: str, start: int) -> int:
        known = next_at.get(needle)
        if known is None or -1 < known < start:
            known = next_at[needle] = text.find(needle, start)
        return known

    while (opened := text.find("<", at)) >= 0 and (end := text.find(">", opened + 1)) >= 0:
        closing = "/" + text[opened + 1 : end]
        closed_at = find(closing, end)
        resume = end + 1 if closed_at < 0 else closed_at + len(closing) + 2
        if opened > at:
            kept.append(text[at:opened])
        if not kept or resume > len(text):
            return "".join(kept) + text[opened:]
        last = kept.pop()[:-1]
        if last:
            kept.append(last)
        at = resume
    return "".join(kept) + text[at:]


def _strip_tags_one_page(text: str) -> str:
    """The characters that get lost are UTF-16 units."""
    if text.isascii() or max(text) <= "\uffff":
        return _cut_tags(text)
    return _from_units(_cut_tags(_as_units(text)))


@F.pandas_udf(StringType())
def strip_tags_compat(text: pd.Series) -> pd.Series:
    return text.map(_strip_tags_one_page, na_action="ignore")


def _where(text: Column, mark: str, step: Callable[[Column], Column], rounds: int = 1) -> Column:
    """Apply a step to pages that hold the mark its pattern needs. The mark is looked for again
    before each round; the text is computed once, as the state of the aggregate."""
    return F.aggregate(
        F.array(*[F.lit(i) for i in range(rounds)]),
        text,
        lambda t, _: F.when(t.contains(mark), step(t)).otherwise(t),
    )


def drop_move_info(text: Column) -> Column:
    """``[[Lyon]] foo ([move])`` becomes ``[[Lyon]]``."""
    return _where(text, "([", lambda t: F.regexp_replace(t, _from(r"\[\[", LINEAR_MOVE_INFO), "$1$2"))


def drop_headers(text: Column) -> Column:
    return F.regexp_replace(text, _from("=", LINEAR_HEADER), "$1")


def drop_quotes(text: Column) -> Column:
    return F.regexp_replace(text, QUOTES, "")


def drop_bullets(text: Column) -> Column:
    return F.replace(text, F.lit("\n* "), F.lit("\n"))


def join_lines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def keep_dates(text: Column) -> Column:
    return _where(text, "{{Date", lambda t: F.regexp_replace(t, LINEAR_DATE, "$1$2"))


def drop_templates(text: Column) -> Column:
    """Innermost templates first, a fixed number of rounds; deeper ones stay."""
    return _where(text, "{{", lambda t: F.regexp_replace(t, TEMPLATE, ""), TEMPLATE_ROUNDS)


def drop_escaped_refs(text: Column) -> Column:
    return _where(text, "&lt;ref&gt;", lambda t: F.regexp_replace(t, LINEAR_ESCAPED_REF, "$1"))


def drop_link_parenthesis(text: Column) -> Column:
    return F.regexp_replace(text, _from(r"\[\[", LINEAR_LINK_PARENTHESIS), "$1$2$3$4")


def keep_link_label(text: Column) -> Column:
    return F.regexp_replace(text, _from(r"\[\[", LINEAR_LINK_LABEL), "$1$2$3$4")


def drop_namespaced_links(text: Column) -> Column:
    return F.regexp_replace(text, _from(r"\[\[", LINEAR_NAMESPACED_LINK), "$1")


def unwrap_links(text: Column) -> Column:
    return F.regexp_replace(text, _from(r"\[\[", LINEAR_LINK), "$1$2")


def blank_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, " ")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def collapse_dots(text: Column) -> Column:
    return F.replace(text, F.lit(". ."), F.lit("."))


def straighten_apostrophes(text: Column) -> Column:
    return F.replace(text, F.lit("’"), F.lit("'"))


# The order is part of the meaning of a cleaned page.
STEPS: tuple[Callable[[Column], Column], ...] = (
    strip_tags,
    drop_move_info,
    drop_headers,
    drop_quotes,
    drop_bullets,
    join_lines,
    keep_dates,
    drop_templates,
    drop_escaped_refs,
    drop_link_parenthesis,
    keep_link_label,
    drop_namespaced_links,
    unwrap_links,
    blank_punctuation,
    collapse_blanks,
    collapse_dots,
    straighten_apostrophes,
)


def clean_text(text: Column, tag_mode: str = "default") -> Column:
    """Clean one page of wikitext.

    ``tag_mode="default"`` removes tags without losing neighbouring characters;
    ``"compat"`` also loses one character on each side of a tag.
    """
    if tag_mode not in ("default", "compat"):
        raise ValueError(f"tag_mode must be 'default' or 'compat', not {tag_mode!r}")
    first = strip_tags if tag_mode == "default" else strip_tags_compat
    for step in (first, *STEPS[1:]):
        text = step(text)
    return text
