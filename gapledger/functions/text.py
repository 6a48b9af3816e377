"""String column expressions (F3-F7, X3). All JVM-side: no Python worker."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounds over all pairs after which a map that may run for ever is an error.
MOST_ROUNDS = 8

# The characters Python's str.strip() treats as whitespace.
# clean_text trims exactly these, so results equal a Python strip().
STRIP_WHITESPACE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# The default clean-up map, in this order.
DEFAULT_CLEANUP = {"\n": " ", "\r": " ", "\t": " ", "  ": " ", '"': "", ",": ""}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _class_escape(chars: str) -> str:
    """Escape characters for use inside a regex character class; valid in
    Java regex (Spark) and RE2 (DuckDB)."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in chars)


def strip_pattern(strip_chars: str = "") -> str:
    cls = STRIP_WHITESPACE + _class_escape(strip_chars)
    return f"^[{cls}]+|[{cls}]+$"


def cleanup_map(replace_extras: dict[str, str] | None = None) -> dict[str, str]:
    """Default map updated by ``replace_extras``. A pair whose replacement
    contains its own key could never reach a fixed point, so it is refused."""
    m = dict(DEFAULT_CLEANUP)
    for k, v in (replace_extras or {}).items():
        if not k:
            raise ValueError("empty search text in replace_extras")
        if k in v:
            raise ValueError(f"replacement for {k!r} contains the key itself")
        m[k] = v
    return m


def _strip_ends(e: Column, strip_chars: str) -> Column:
    """Trim whitespace and ``strip_chars`` from both ends in one anchored
    match: skip the leading run, then capture up to the last character
    outside the set. (An unanchored ``[...]+$`` would be retried at every
    whitespace run of the text.)"""
    cls = STRIP_WHITESPACE + _class_escape(strip_chars)
    return F.regexp_extract(e, f"(?s)^[{cls}]*(.*[^{cls}])?", 1)


def clean_text(c, strip_chars: str | list[str] = "", replace_extras: dict[str, str] | None = None) -> Column:
    """Text clean-up to a fixed point.

    Result: every mapped text replaced, no quotes or commas, CR/LF/TAB become
    spaces, runs of spaces become one, and whitespace plus ``strip_chars`` are
    trimmed from both ends. Deletions run first so that removing a character
    can never leave a double space behind; the space collapse runs last.
    With only the default map this equals replacing until nothing changes, in
    one pass; with extra pairs the passes are really repeated
    (``_until_settled``).
    """
    if isinstance(strip_chars, (list, tuple)):
        strip_chars = "".join(strip_chars)
    m = cleanup_map(replace_extras)
    e = _col(c)
    if m != DEFAULT_CLEANUP:
        return _until_settled(e, m, strip_chars)
    for k in [k for k, v in m.items() if v == ""]:
        e = F.replace(e, F.lit(k), F.lit(""))  # byte search, no per-character map
    ws_to_space = all(m.get(k) == " " for k in ("\n", "\r", "\t"))
    collapse = m.get("  ") == " "
    if ws_to_space and collapse:
        # CR/LF/TAB to a space and space runs to one space, in one pass
        e = F.regexp_replace(e, "[\\n\\r\\t ]{2,}|[\\n\\r\\t]", " ")
    else:
        if ws_to_space:
            e = F.regexp_replace(e, "[\\n\\r\\t]", " ")
        if collapse:
            e = F.regexp_replace(e, " {2,}", " ")
    return _strip_ends(e, strip_chars)


def _gone(e: Column, k: str, v: str) -> Column:
    """``k`` replaced by ``v`` until the text holds no ``k``."""
    if len(set(k)) == 1 and v == k[0] * len(v) and len(k) > 1:  # a run shrinks, by the same steps whatever its place
        c, step = re.escape(k[0]), len(k) - len(v)
        if step == 1 and v:
            return F.regexp_replace(e, f"{c}{{{len(k)},}}", v)
        return F.regexp_replace(e, f"(?<!{c})({c}{{{len(v)},{len(k) - 1}}}?)(?:{c}{{{step}}})+(?!{c})", "$1")
    if len(k) == 1 or (v and not set(k) & set(v)):  # no new one can arise
        return F.replace(e, F.lit(k), F.lit(v))

    def step_(t: Column) -> Column:
        return F.replace(t, F.lit(k), F.lit(v))

    def more(t: Column) -> Column:
        # each step shortens a text that still holds k; a pair that does not shorten moves across it in about twice its length
        bound = (F.floor(F.length(t) / (len(k) - len(v))) if len(k) > len(v) else 2 * F.length(t)).cast("int") + 1
        done = F.aggregate(F.sequence(F.lit(1), bound), t, lambda x, _: step_(x))
        return _let(done, lambda d: F.when(F.contains(d, F.lit(k)), F.raise_error(F.concat(
            F.lit(f"clean_text: {k!r} is still there after so many steps: "), bound.cast("string")))).otherwise(d))

    return _let(step_(e), lambda t: F.when(F.contains(t, F.lit(k)), more(t)).otherwise(t))


def _let(x: Column, f) -> Column:
    """``f`` of ``x``, with ``x`` computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def most_rounds(m: dict[str, str]) -> int | None:
    """Rounds over all pairs, in map order, that settle any text; None if the
    pairs may feed each other in a circle. One pair can feed another if its
    replacement holds, lies in, or borders on a part of the other's key; a
    deletion can feed every key of two letters or more. Without a circle, a
    round at least exhausts the pairs that nothing feeds, the next one those
    that only these feed, and so on."""
    def feeds(v: str, k: str) -> bool:
        if not v:
            return len(k) > 1
        ends = any(v.endswith(k[:i]) or v.startswith(k[-i:]) for i in range(1, min(len(k), len(v)) + 1))
        return k in v or v in k or ends

    fed = {k: {j for j, v in m.items() if j != k and feeds(v, k)} for k in m}
    rounds, left = 0, set(m)
    while left:
        free = {k for k in left if not fed[k] & left}
        if not free:
            return None
        left -= free
        rounds += 1
    return rounds + 1  # trimming may have more to do after the last pair


def _until_settled(e: Column, m: dict[str, str], strip_chars: str) -> Column:
    """Rounds of trimming and of all pairs in map order, until a round changes
    nothing; a settled text gets no further round. Most texts settle in the
    first three, which are spelled out; the others go on in a fold that carries
    whether they have settled, for as many rounds as the pairs (``most_rounds``)
    or the text's length allow. Only where pairs feed each other in a circle
    and one lengthens the text is a text that has not settled after MOST_ROUNDS
    an error; it is never returned half done."""
    known = most_rounds(m)
    spaces = list(m.items())[:4] == list(DEFAULT_CLEANUP.items())[:4]

    def one_round(t: Column) -> Column:
        t = _strip_ends(t, strip_chars)
        if spaces:  # the first four pairs make one space of any run
            t = F.regexp_replace(t, "[\\n\\r\\t ]{2,}|[\\n\\r\\t]", " ")
        for k, v in list(m.items())[4 * spaces:]:
            t = _gone(t, k, v)
        return t

    def fold(t: Column) -> Column:
        if known is not None:
            bound = F.lit(known + 1)
        elif any(len(v) > len(k) for k, v in m.items()):
            bound = F.lit(MOST_ROUNDS)
        else:
            bound = (len(m) + 1) * (F.length(t) + 1)
        start = F.struct(t.alias("t"), F.lit(False).alias("settled"))
        ends = F.aggregate(F.sequence(F.lit(1), bound), start, lambda s, _: F.when(s["settled"], s).otherwise(
            _let(one_round(s["t"]), lambda d: F.struct(d.alias("t"), (d == s["t"]).alias("settled")))))
        return _let(ends, lambda s: F.when(s["settled"], s["t"]).otherwise(
            F.raise_error(F.concat(F.lit("clean_text: not settled after so many rounds: "), bound.cast("string")))))

    def go_on(t: Column, rounds: int) -> Column:
        if not rounds:
            return fold(t)
        return _let(one_round(t), lambda d: F.when(d == t, d).otherwise(go_on(d, rounds - 1)))

    return _strip_ends(_let(one_round(e), lambda t: F.when(t.isNotNull(), go_on(t, 2))), "")


def clean_text_sql(expr: str) -> str:
    """The same default clean-up as ANSI/DuckDB SQL text (for oracles)."""
    return (
        "regexp_replace(regexp_replace(regexp_replace("
        f"replace(replace({expr}, '\"', ''), ',', ''), '[\\n\\r\\t]', ' ', 'g'), ' {{2,}}', ' ', 'g'), "
        f"'{strip_pattern()}', '', 'g')"
    )


def find_pos(c, marker: str) -> Column:
    """0-based position of ``marker``, or -1 when absent."""
    return F.instr(_col(c), marker) - 1


def slice_between(c, start_marker: str, end_marker: str | None = None) -> Column:
    """Text from the first ``start_marker`` (included) up to the next
    ``end_marker`` (excluded), or to the end when the end marker is missing.
    Null when the start marker is absent (F4)."""
    col = _col(c)
    pos = F.instr(col, start_marker)
    rest = col.substr(pos, F.length(col))
    if end_marker is not None:
        rest = F.substring_index(rest, end_marker, 1)
    return F.when(pos > 0, rest)


def text_after(c, marker: str) -> Column:
    """Everything after the first ``marker``, trimmed; null when absent."""
    col = _col(c)
    pos = F.instr(col, marker)
    return F.when(pos > 0, F.trim(col.substr(pos + len(marker), F.length(col))))


def value_after(c, key: str, value_pattern: str = r"[^\"]*") -> Column:
    """The value that follows ``key`` and its punctuation, by pattern.
    Null when the key is absent or no value follows it; never a slice of the
    wrong part of the line."""
    pat = key + r"\W+(" + value_pattern + ")"
    v = F.regexp_extract(_col(c), pat, 1)
    return F.when(v != "", v)


def contains(c, text: str) -> Column:
    """Substring test."""
    return F.contains(_col(c), F.lit(text))
