"""Scalar functions shared by the stages: blank tests, ids, masks, versioned names, event text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys whose scalars are masked in JSON, name parts that mask a configuration value.
SECRET_PARTS = ("password", "secret", "token", "keytab", "jaas", "credential")
MASK = "***"
SECRET_KEYS = ("birthdate", "clientSnils", "snils", "inn", "number", "series", "departmentCode")
INLINE_KEYS = ("birthdate", "clientSnils", "snils", "number", "series", "departmentCode")
SECRET_NAME_PARTS = ("snils", "birthdate", "passport", "number")
#: Single-byte code pages of message bodies by the id that messages carry; 1208 is UTF-8, 1200 UTF-16, 819 Latin-1.
CODE_PAGES = (37, 273, 437, 500, 737, 775, 850, 852, 855, 857, 858, 860, 861, 862, 863, 864, 865, 866, 869, 874, 1026, 1140, 1250, 1251, 1252, 1253, 1254, 1255, 1256, 1257, 1258)
#: White space that ``strip`` trims.
WHITE = " \t\n\x0b\f\r"


def strip(x: Column) -> Column:
    """Trim all white space, not spaces only."""
    return F.btrim(x, F.lit(WHITE))


def nullif_blank(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def null_like(x: Column) -> Column:
    """Blank and 'none' (any case) become null."""
    return F.when(F.lower(strip(x)).isin("", "none"), None).otherwise(x)


def null_like_json(payload: Column) -> Column:
    """JSON, compact or spaced, with null-like object values set to null; array elements stay."""
    blank = r"(?:\s|\\[tnrf])*+"
    return F.regexp_replace(payload, rf'(?i):\s*+"{blank}(?:none{blank})?"(?=\s*+[,}}])', ":null")


def event_id(binary_id: Column, text_id: Column) -> Column:
    """Upper-case hex of the id padded or cut to 24 bytes, else the text id, else 'unknown'."""
    padded = F.substring(F.concat(binary_id, F.lit(b"\0" * 24)), 1, 24)
    return F.coalesce(F.hex(padded), nullif_blank(text_id), F.lit("unknown"))


def mask_config(key: Column, value: Column) -> Column:
    return F.when(F.lower(key).rlike("|".join(SECRET_PARTS)), F.lit(MASK)).otherwise(value)


_STRING = r'"(?:[^"\\]++|\\.)*+(?:"|\\?\z)'


def _nest(levels: int) -> str:
    """Pattern of an object or array that nests ``levels`` more; it may be cut off by the text's end."""
    inner = "" if not levels else f"|{_nest(levels - 1)}"
    return rf'[\[{{](?:[^\[\]{{}}"]++|{_STRING}{inner})*+(?:[\]}}]|\z)'


_SCALAR = r"[-0-9.eE+]+|true|false|null"
#: Strings, brackets, and what lies between; together they are the whole text.
_TOKEN = rf'{_STRING}|[\[{{]|[\]}}]|[^"\[\]{{}}]++'


def mask_json(payload: Column, keys: list[str] | tuple[str, ...] = SECRET_KEYS) -> Column:
    """Whatever stands under the given keys (any case, any depth, compact or spaced JSON) becomes the mask: scalars, objects
    and arrays, also those that the text's end cuts off.

    A pattern masks what nests nine levels at most; a text that has more under a key is folded token by token.
    """
    value = rf"(?:{_STRING}|{_SCALAR}|{_nest(8)})"
    named = rf'(?i)"({"|".join(keys)})"\s*+:\s*+'
    left = F.regexp_replace(payload, named + value, rf'"$1":"{MASK}"')
    return F.when(left.rlike(named + r"[\[{]"), _mask_tokens(payload, keys)).otherwise(left)


def _mask_tokens(payload: Column, keys: list[str] | tuple[str, ...]) -> Column:
    """As ``mask_json``, at any depth: one fold over the tokens that counts brackets."""
    state = lambda out, depth, hidden, key, value: F.struct(out.alias("out"), depth.cast("int").alias("depth"), hidden.cast("int").alias("hidden"), key.alias("key"), value.alias("value"))
    none, mask = F.lit(-1), F.lit(f'"{MASK}"')
    secret, after = rf'(?i)"({"|".join(keys)})"', r"^\s*+:\s*+"

    def step(s: Column, t: Column) -> Column:
        opens, closes, no = t.isin("[", "{"), t.isin("]", "}"), F.lit(False)
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        inside = state(s["out"], depth, F.when(closes & (depth == s["hidden"]), none).otherwise(s["hidden"]), no, no)
        hides = state(F.concat(s["out"], mask), depth, F.when(opens, s["depth"]).otherwise(none), no, no)
        colon = s["key"] & t.rlike(after)
        scalar = t.rlike(rf"(?i){after}(?:{_SCALAR})")
        named = state(F.concat(s["out"], F.when(scalar, F.regexp_replace(t, rf"(?i){after}(?:{_SCALAR})", f':"{MASK}"')).otherwise(":")), depth, none, no, ~scalar)
        plain = state(F.concat(s["out"], t), depth, none, F.startswith(t, F.lit('"')) & F.regexp_like(t, F.lit(f"^{secret}$")), no)
        return F.when(s["hidden"] >= 0, inside).when(s["value"] & (opens | F.startswith(t, F.lit('"'))), hides).when(colon, named).otherwise(plain)

    start = state(F.lit(""), F.lit(0), none, F.lit(False), F.lit(False))
    return F.aggregate(F.regexp_extract_all(payload, F.lit(_TOKEN), F.lit(0)), start, step, lambda s: s["out"])


def mask_payload(payload: Column, keys: list[str] | tuple[str, ...] = SECRET_KEYS) -> Column:
    """A payload to show: masked as JSON where it is JSON, else the texts of secret keys (as spelled) and whatever else looks like one."""
    return F.when(F.try_parse_json(payload).isNotNull(), mask_json(payload, keys)).otherwise(mask_inline(mask_json(payload, keys), [k for k in keys if k in INLINE_KEYS]))


def mask_inline(text: Column, keys: list[str] | tuple[str, ...] = INLINE_KEYS) -> Column:
    """The texts of the given keys (as spelled) in what is no JSON."""
    for key in keys:
        text = F.regexp_replace(text, rf'("{key}"\s*:\s*")[^"]*(")', f"$1{MASK}$2")
    return text


def mask_map(m: Column, keys: list[str] | tuple[str, ...] = SECRET_KEYS, parts: tuple[str, ...] = SECRET_NAME_PARTS) -> Column:
    """Values of the given keys (any case) and of keys that contain one of ``parts`` become the mask."""
    return F.transform_values(m, lambda k, v: F.when(F.lower(k).isin([x.lower() for x in keys]) | F.lower(k).rlike("|".join(parts)), F.lit(MASK)).otherwise(v))


def mask_url(url: Column) -> Column:
    """Store passwords among a broker address's parameters become the mask."""
    return F.regexp_replace(url, "(?i)((?:trustStore|keyStore)Password=)[^&]*", f"$1{MASK}")


def preview(text: Column, most: int) -> Column:
    """At most ``most`` characters, then '...'."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text)


def quoted(x: Column) -> Column:
    """A JSON string (null: null)."""
    text = F.to_json(F.array(x))
    # most texts have nothing to escape
    return F.when(x.rlike(r'["\\\x00-\x1f]'), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(F.concat(F.lit('"'), x, F.lit('"')))


def json_or_text(x: Column) -> Column:
    """JSON as it is, other text as a JSON string, nothing as null."""
    return F.when(x.isNull(), F.lit("null")).when(F.try_parse_json(x).isNotNull(), x).otherwise(quoted(x))


def iso_utc(ts: Column) -> Column:
    """Instant as UTC text with milliseconds, whatever the session's zone and its summer time: no local time comes between."""
    ms = F.unix_millis(ts)
    seconds = F.make_dt_interval(secs=F.floor(ms / 1000).cast("decimal(18,6)"))
    text = (F.expr("timestamp_ntz '1970-01-01 00:00:00'") + seconds).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("Z"))


def local_name(key: Column) -> Column:
    """The field that a ``mapping.`` key names."""
    return strip(F.when(key.startswith("mapping."), F.substring(key, F.lit(9), F.length(key))).otherwise(key))


def versioned_name(name: Column, version: Column) -> Column:
    return F.concat_ws("_", name, version.cast("string"))


def rule_key(rule: Column) -> Column:
    """'Rule123' becomes '123'; other names are trimmed."""
    return F.regexp_replace(strip(rule), r"(?i)^Rule(\d+)$", "$1")


def version_of(name: Column) -> Column:
    """The number after the last underscore of a versioned name; null where there is none."""
    return F.regexp_extract(name, r"_(\d+)$", 1).try_cast("long")


def version_text(name: Column) -> Column:
    """What follows the last underscore of a versioned name, trimmed; a name without it, or with nothing after it, is an error."""
    found = nullif_blank(F.when(F.contains(name, F.lit("_")), F.substring_index(name, "_", -1)))
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("no version in cache name "), F.coalesce(name, F.lit("?")))).cast("string")).otherwise(found)


def _single_byte(body: Column, page: int) -> Column:
    """Bytes of a single-byte code page: each is read as Latin-1, then those that differ are put right."""
    latin, own = bytes(range(256)).decode("latin-1"), bytes(range(256)).decode(f"cp{page:03d}", "replace")
    differ = [(a, b) for a, b in zip(latin, own, strict=True) if a != b]
    return F.translate(F.decode(body, "ISO-8859-1"), "".join(a for a, _ in differ), "".join(b for _, b in differ))


def decode_body(body: Column, code_page: Column, supported: bool = True) -> Column:
    """Body bytes by code page id; ids of no page, 0 and less are UTF-8. Bytes that a page leaves open become U+FFFD.

    With ``supported`` false, bodies of single-byte pages other than Latin-1 are null, for a reject.
    """
    out = F.when(code_page == 1200, F.decode(body, "UTF-16")).when(code_page == 819, F.decode(body, "ISO-8859-1"))
    for page in CODE_PAGES:
        out = out.when(code_page == page, _single_byte(body, page) if supported else F.lit(None))
    return out.otherwise(F.decode(body, "UTF-8"))


def message_body(text: Column, body: Column) -> Column:
    """Text as it is, bytes as UTF-8; null for a body of any other kind."""
    return F.coalesce(text, F.decode(body, "UTF-8"))


def positive_or_null(ms: Column) -> Column:
    """Milliseconds since 1970; 0 and less are unknown."""
    return F.when(ms > 0, ms)


def _escaped(x: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def cef_header(x: Column) -> Column:
    return _escaped(x, ("\\", "\\\\"), ("|", "\\|"), ("\n", " "), ("\r", " "))


def cef_value(x: Column) -> Column:
    return _escaped(x, ("\\", "\\\\"), ("=", "\\="), ("\n", "\\n"), ("\r", "\\r"))


# --- addresses ----------------------------------------------------------------------------------


def _first(x: Column) -> Column:
    return F.split_part(x, F.lit(","), F.lit(1))


def url_scheme(url: Column) -> Column:
    return F.nullif(F.regexp_extract(_first(url), r"^\s*([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit(""))


def url_host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(_first(url), r"^[^:]+://(?:[^@/?#]*@)?(\[[^\]]+\]|[^:/?#\s]+)", 1), F.lit(""))


def url_port(url: Column) -> Column:
    return F.regexp_extract(_first(url), r"^[^:]+://(?:[^@/?#]*@)?(?:\[[^\]]+\]|[^:/?#\s]+):(\d+)", 1).try_cast("int")


def server_host(servers: Column) -> Column:
    """Host of the first of comma-separated ``host:port``, ``[v6]:port`` or ``host``."""
    first = strip(_first(servers))
    six, plain = F.regexp_extract(first, r"^\[([^\]]+)\]", 1), F.regexp_extract(first, r"^(.+):[^:]*$", 1)
    return nullif_blank(F.when(six != "", six).when(plain != "", plain).otherwise(first))


def server_port(servers: Column) -> Column:
    first = strip(_first(servers))
    six, plain = F.regexp_extract(first, r"^\[[^\]]+\]:(.+)$", 1), F.regexp_extract(first, r"^.+:([^:]*)$", 1)
    return F.when(first.rlike(r"^\[[^\]]+\]"), six).otherwise(plain).try_cast("int")


def first_text(*candidates: Column) -> Column:
    """The first that is neither blank nor '<empty>'."""
    return F.coalesce(*[F.when(nullif_blank(c).isNotNull() & (c != "<empty>"), c) for c in candidates])


def first_positive(*candidates: Column) -> Column:
    return F.coalesce(*[F.when(c > 0, c) for c in candidates])
