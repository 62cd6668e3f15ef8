"""HL7 v2 text to typed segment tables, set-based and with native expressions only.

A file's text is split into messages, messages into segment rows, and a segment's layout
(``hl7_layouts``) is compiled into two projections. Separators are per message: a message
with unusual ones is mapped to the usual ones first (and its texts back at the end), so every
split has a constant pattern and ordinary messages pay nothing for it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import HL7_DTM, HL7_FILL
from tidemark.sources.hl7_layouts import COMPOSITES, SEGMENTS, SINGLE

ENVELOPE = ["FHS", "BHS", "BTS", "FTS"]
# Fixed value: named columns of a segment without a layout; further fields go into one array column.
GENERIC_FIELDS = 25
# The usual separators (field, component, repetition, sub-component, escape) and
# the order in which MSH names the last four.
USUAL = "|^~&\\"
MSH_ORDER = "^~\\&"
FS, CS, RS, SS = r"\|", r"\^", "~", "&"
# Stand-ins inside the job: separators that came out of an escape sequence, and usual
# separator characters that are ordinary text in a message with other separators.
DECODED, ORDINARY = "\x1c\x1d\x1e\x1f", "\x01\x02\x03\x04\x05"


def _translate(c, old: Column, new: Column) -> Column:
    """``translate`` with per-row characters."""
    return F.call_function("translate", F.col(c) if isinstance(c, str) else c, old, new)


def _blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def decode_payload(text: Column) -> Column:
    """Base64 payload as text."""
    return F.decode(F.unbase64(text), "UTF-8")


# No filter is put on top of these projections: it would be pushed below them and repeat the
# splitting. What is not wanted becomes null or an empty list, which ``explode`` drops.


def _parts(text: str) -> Column:
    """The text cut before every MSH line; line ends are carriage returns."""
    cr = F.concat(F.lit("\r"), F.replace(F.replace(F.col(text), F.lit("\r\n"), F.lit("\r")), F.lit("\n"), F.lit("\r")))
    return F.split(F.regexp_replace(cr, "\r((?i)MSH)", "\x00$1"), "\x00")


def _lines(part: Column) -> Column:
    """Non-blank lines, envelope lines dropped."""
    return F.filter(F.split(part, "\r"), lambda x: (F.trim(x) != "") & ~F.upper(F.substring(x, 1, 3)).isin(ENVELOPE))


def split_messages(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep..., message): a batch is cut before each MSH line, envelope lines are dropped.

    Lines before the first MSH form a fragment of their own.
    """
    whole = F.transform(_parts(text), lambda p: F.array_join(_lines(p), "\r"))
    return df.select(*keep, F.explode(F.filter(whole, lambda m: m != "")).alias("message"))


def _prepared(lines: DataFrame, keep: list[str]) -> DataFrame:
    """keep..., message columns, ``__lines`` with the usual separators (null without MSH),
    ``__plain`` (nothing was mapped) and ``__own`` (the message's characters, to map back)."""
    head = lines.select(*keep, "__lines", F.get("__lines", F.lit(0)).alias("__msh"))
    m = F.col("__msh")
    rest = F.when(F.length(m) >= 8, F.substring(m, 5, 4)).otherwise(F.lit(MSH_ORDER))
    at = lambda i: F.substring(rest, i, 1)
    own = F.when(
        (F.upper(F.substring(m, 1, 3)) == "MSH") & (F.length(m) >= 4), F.concat(F.substring(m, 4, 1), at(1), at(2), at(4), at(3))
    )
    head = head.select(*keep, "__lines", own.alias("__own")).withColumn("__plain", F.col("__own") == USUAL)
    odd = F.transform("__lines", lambda x: _translate(x, F.concat("__own", F.lit(USUAL)), F.lit(USUAL + ORDINARY)))
    mapped = F.when(F.col("__plain"), F.col("__lines")).when(F.col("__own").isNotNull(), odd)
    head = head.select(*keep, "__own", "__plain", mapped.alias("__lines"))
    head = head.select("*", F.split(F.get("__lines", F.lit(0)), FS).alias("__m"))
    part = lambda n: _blank(_back(F.get("__m", F.lit(n - 1)), "__plain"))  # noqa: E731 - MSH-n sits one lower here
    return head.select(
        *keep, part(10).alias("message_id"), part(7).alias("message_timestamp"), part(12).alias("hl7_version"), "__own", "__plain", "__lines"
    )


def _back(c: Column, as_is: str) -> Column:
    """Text with the message's own characters again; unchanged where the flag ``as_is`` is set."""
    own = F.col("__own")
    mapped = _translate(c, F.lit(USUAL + DECODED + ORDINARY), F.concat(own, F.substring(own, 1, 4), F.lit(USUAL)))
    return F.when(F.col(as_is), c).otherwise(mapped)


def _raw(c: Column) -> Column:
    return _back(c, "__plain")


def _dec(c: Column) -> Column:
    return _back(c, "__asis")


def _unescaped(line: Column) -> Column:
    """Escape sequences decoded: separators, highlighting dropped, the escape itself last."""
    out = line
    for letter, value in zip("FSRT", DECODED):
        out = F.replace(out, F.lit(f"\\{letter}\\"), F.lit(value))
    for seq, value in (("\\H\\", ""), ("\\N\\", ""), ("\\E\\", "\\")):
        out = F.replace(out, F.lit(seq), F.lit(value))
    return out


def _segment_name(line: Column) -> Column:
    return F.upper(F.trim(F.substring_index(line, "|", 1)))


def _with_fields(rows: DataFrame) -> DataFrame:
    """``fields[n]`` is field n (MSH-1 is the separator), ``decoded[n]`` the same without escapes."""

    def cut(line: Column) -> Column:
        parts = F.split(line, FS)
        rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.when(F.col("segment") == "MSH", F.concat(F.array(F.lit("MSH"), F.lit("|")), rest)).otherwise(parts)

    line = F.col("__line")
    rows = rows.select("*", F.contains(line, F.lit("\\")).alias("__esc"), _raw(line).alias("raw_segment"), cut(line).alias("fields"))
    decoded = F.when(F.col("__esc"), cut(_unescaped(line))).otherwise(F.col("fields"))
    asis = F.col("__plain") & ~F.col("__esc")
    return rows.select("*", decoded.alias("decoded"), asis.alias("__asis")).drop("__line", "__esc")


def _segments(lines: DataFrame, keep: list[str], only: str | None) -> DataFrame:
    base = _prepared(lines, keep)
    wanted = F.filter("__lines", lambda x: _segment_name(x) == only if only else _segment_name(x) != "")
    head = [c for c in base.columns if c != "__lines"]
    rows = base.select(*head, F.posexplode(wanted).alias("__pos", "__line"))
    named = rows.select(*head, (F.col("__pos") + 1).alias("ordinal"), _segment_name(F.col("__line")).alias("segment"), "__line")
    return _with_fields(named)


def segments(df: DataFrame, message: str, keep: list[str], only: str | None = None) -> DataFrame:
    """One row per segment: keep..., message columns, segment, ordinal, raw_segment, fields.

    The ordinal counts from 1 among the segments of the message, or, with ``only``, among
    those of that name. Messages without an MSH line are dropped.
    """
    return _segments(df.select(*keep, F.split(message, "\r").alias("__lines")), keep, only)


# --- access -----------------------------------------------------------------------------


def field(n: int) -> Column:
    """Raw field n of a segment row, empty is null."""
    return _blank(_raw(F.get("fields", F.lit(n))))


def repetitions(n: int) -> Column:
    """The non-empty repetitions of field n, still with internal separators."""
    return F.filter(F.split(F.get("fields", F.lit(n)), RS), lambda r: r != "")


def first_repetition(n: int) -> Column:
    return _blank(_raw(F.substring_index(F.get("fields", F.lit(n)), "~", 1)))


def component(n: int, c: int) -> Column:
    """Component c of field n, decoded; out of range or empty is null."""
    return _blank(_dec(F.get(F.split(F.get("decoded", F.lit(n)), CS), F.lit(c - 1))))


def sub_component(n: int, c: int, s: int) -> Column:
    comp = F.get(F.split(F.get("decoded", F.lit(n)), CS), F.lit(c - 1))
    return _blank(_dec(F.get(F.split(comp, SS), F.lit(s - 1))))


# --- compiling layouts ------------------------------------------------------------------
# A layout becomes SQL text: one short expression per column, parsed by Spark, instead of
# thousands of small column objects.

_PART = re.compile(r"^(\w+?)(?:@(\d+)(?:\.(\d+))?(\?)?)?(:dtm)?$")


def parts_of(spec: str) -> list[tuple[str, int, int | None, bool, bool]]:
    """(name, component, sub-component, fall back, is date-time) of a composite's text."""
    out, at = [], 0
    for word in spec.split():
        name, comp, sub, whole, dtm = _PART.match(word).groups()
        at = int(comp) if comp else at + 1
        out.append((name, at, int(sub) if sub else None, bool(whole), bool(dtm)))
    return out


def _text(x: str, flag: str) -> str:
    """``_back`` and empty-to-null as SQL; ``__from``/``__to`` hold the characters."""
    return f"nullif(if({flag}, {x}, translate({x}, __from, __to)), '')"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` computed once and called ``name`` in it."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _dtm(x: str) -> str:
    """``hl7_dtm`` as SQL; the text is cleaned and taken apart once."""
    cut = f"struct(regexp_extract(t, r'{HL7_DTM}', 1) as d, regexp_extract(t, r'{HL7_DTM}', 2) as o)"
    full = f"concat(p.d, substring('{HL7_FILL}', length(p.d) + 1, 14), if(p.o = '', 'Z', p.o))"
    iso = f"""date_format(try_to_timestamp({full}, 'yyyyMMddHHmmssXX'), "yyyy-MM-dd'T'HH:mm:ss")"""
    return _let("t", f"regexp_replace(trim({x}), '^[()]+|[()]+$', '')", f"if(t is null, null, {_let('p', cut, iso)})")


def _int(x: str) -> str:
    return f"if(trim({x}) rlike r'^[+-]?\\d+$', try_cast(trim({x}) as bigint), null)"


def _cut(x: str, sep: str) -> str:
    return f"split({x}, r'{sep}')"


def _struct(named: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in named) + ")"


def _filled(named: list[tuple[str, str]]) -> str:
    """The struct of the parts, or null when all of them are null."""
    seen = " or ".join(f"({e}) is not null" for _, e in named)  # the first part found ends the test
    return f"if({seen}, {_struct(named)}, null)"


def _members(spec: str, comps: str, flag: str) -> list[tuple[str, str]]:
    """The parts of a composite from its component array."""
    out = []
    for name, comp, sub, whole, dtm in parts_of(spec):
        raw = f"get({comps}, {comp - 1})"
        value = _text(raw, flag)
        if sub is not None:
            piece = _text(f"get({_cut(raw, SS)}, {sub - 1})", flag)
            value = f"coalesce({piece}, {value})" if whole else piece
        out.append((name, _dtm(value) if dtm else value))
    return out


def _pair(comps: str, flag: str) -> list[tuple[str, str]]:
    """Entity identifier pair: placer and filler, each made of sub-components."""
    names = [p[0] for p in parts_of(COMPOSITES["EI"])]

    def side(i: int) -> str:
        subs = _cut(f"get({comps}, {i})", SS)
        return _filled([(n, _text(f"get({subs}, {j})", flag)) for j, n in enumerate(names)])

    return [("placer_assigned_identifier", side(0)), ("filler_assigned_identifier", side(1))]


def _composite(comps: str, kind: str) -> str:
    """One composite as a struct. A coded value or designator stays a struct of nulls when
    its text is only separators; the others become null."""
    if kind == "EIP":
        return _filled(_pair(comps, "__asis"))
    members = _members(COMPOSITES[kind], comps, "__asis")
    return f"if({comps} is not null, {_struct(members)}, null)" if kind in ("CWE", "HD") else _filled(members)


def _repeated(n: int, kind: str) -> str:
    """All non-empty repetitions of field n as an array; none is null."""
    reps = f"filter({_cut(f'get(fields, {n})', RS)}, r -> r <> '')"
    if kind == "st":
        out = f"transform({reps}, r -> {_text('r', '__plain')})"
    elif kind == "id":
        out = f"array_compact(transform({reps}, r -> {_text(_first('r', '^'), '__plain')}))"
    elif kind == "dtm":
        out = f"array_compact(transform({reps}, r -> {_dtm(_text('r', '__plain'))}))"
    else:
        named = _pair("c", "__plain") if kind == "EIP" else _members(COMPOSITES[kind], "c", "__plain")
        out = f"transform(transform({reps}, r -> {_cut('r', CS)}), c -> {_struct(named)})"
    return f"get(filter(array({out}), a -> size(a) > 0), 0)"


def _first(x: str, sep: str) -> str:
    return f"substring_index({x}, '{sep}', 1)"


def layout(segment: str) -> list[tuple[int, str, str, bool]]:
    """(field number, name, type, repeating) of a segment."""
    out = []
    for n, word in enumerate(SEGMENTS[segment].replace("\n", " ").split(","), start=1):
        name, _, kind = word.strip().partition(":")
        if name != "-":
            out.append((n, name, kind.rstrip("*") or "st", kind.endswith("*")))
    return out


def compile_field(n: int, name: str, kind: str, repeating: bool) -> list[tuple[str, str]]:
    """(column, SQL) of one field."""
    whole = _text(f"get(fields, {n})", "__plain")
    first = _text(_first(f"get(fields, {n})", "~"), "__plain")
    part = lambda i: _text(f"get({_cut(f'get(decoded, {n})', CS)}, {i})", "__asis")
    if repeating:
        return [(name, _repeated(n, kind))]
    if kind == "range":
        return [(f"{name}_start", _dtm(part(0))), (f"{name}_end", _dtm(part(1)))]
    if kind == "authority":
        return [(name + s, part(i)) for i, s in enumerate(["", "_universal_id", "_universal_id_type"])]
    if kind == "message":
        return [(s, part(i)) for i, s in enumerate(["message_code", "trigger_event", "message_structure"])]
    if kind in COMPOSITES or kind == "EIP":
        return [(name, _composite(f"__c{n}", kind))]
    plain = {
        "st": whole, "int": _int(whole), "seq": f"coalesce({_int(whole)}, 1L)", "dtm": _dtm(whole), "first": first, "firstdtm": _dtm(first),
    }
    return [(name, plain[kind])]


METADATA = ["message_id", "message_timestamp", "hl7_version", "source_file", "send_time", "create_time", "raw_segment"]


def _rows(df: DataFrame, text: str, segment: str, source_file: str, send_time: str | None, create_time: str | None, base64: bool) -> DataFrame:
    """Segment rows of one name with the common columns; the creation time falls back to the send time."""
    none = F.lit(None).cast("string")
    sent = F.col(send_time) if send_time else none
    made = F.coalesce(_blank(F.col(create_time)), sent) if create_time else sent
    body = decode_payload(F.col(text)) if base64 else F.col(text)
    raw = df.select(F.col(source_file).alias("source_file"), sent.alias("send_time"), made.alias("create_time"), body.alias("__text"))
    keep = ["source_file", "send_time", "create_time"]
    parts = raw.select(*keep, F.explode(_parts("__text")).alias("__part"))
    return _segments(parts.select(*keep, _lines(F.col("__part")).alias("__lines")), keep, segment.upper())


def table(df: DataFrame, text: str, segment: str, source_file: str, send_time: str | None = None, create_time: str | None = None, base64: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Typed rows of one segment of all messages in ``text``.

    Unknown and Z segments get ``segment_type`` and ``field_1`` to ``field_25``. A repeating
    segment without a set id of its own gets its ordinal. ``columns`` compiles only those.
    """
    name = segment.upper()
    rows = _rows(df, text, name, source_file, send_time, create_time, base64)
    if name not in SEGMENTS:
        generic = [field(i).alias(f"field_{i}") for i in range(1, GENERIC_FIELDS + 1)]
        size = F.size("fields")
        places = F.when(size > GENERIC_FIELDS + 1, F.sequence(F.lit(GENERIC_FIELDS + 1), size - 1))
        more = F.transform(places, lambda n: _blank(_raw(F.get("fields", n))))
        return rows.select(*METADATA, F.col("segment").alias("segment_type"), *generic, more.alias("more_fields"))
    fields = layout(name)
    if columns is not None:
        wanted = set(columns)
        fields = [f for f in fields if any(c in wanted for c in _names(f))]
    # the components of single composites are cut once, in a projection of their own
    single = [n for n, _, kind, many in fields if not many and (kind in COMPOSITES or kind == "EIP")]
    own = F.col("__own")
    rows = rows.select(
        "*", F.lit(USUAL + DECODED + ORDINARY).alias("__from"), F.concat(own, F.substring(own, 1, 4), F.lit(USUAL)).alias("__to")
    )
    rows = rows.selectExpr("*", *[f"split(nullif(get(decoded, {n}), ''), r'{CS}') as __c{n}" for n in single])
    cols = [f"{sql} as {column}" for f in fields for column, sql in compile_field(*f)]
    if name not in SINGLE and not any(f[1] == "set_id" for f in layout(name)):
        cols.insert(0, "bigint(ordinal) as set_id")
    # a message has one MSH row; other segments may repeat
    if name == "MSH":
        rows = rows.filter(F.col("ordinal") == 1)
    return rows.selectExpr(*METADATA, *cols)


def _names(f: tuple[int, str, str, bool]) -> list[str]:
    _, name, kind, _ = f
    if kind == "range":
        return [f"{name}_start", f"{name}_end"]
    if kind == "authority":
        return [name, f"{name}_universal_id", f"{name}_universal_id_type"]
    return ["message_code", "trigger_event", "message_structure"] if kind == "message" else [name]


def primary_keys(segment: str) -> list[str]:
    name = segment.upper()
    return ["message_id"] if name in SINGLE or name not in SEGMENTS else ["message_id", "set_id"]
