"""Tokenising identifiers and counting sensitive values."""

from __future__ import annotations

import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: surrogate label in front of a token.
TOKEN_PREFIX = "IMSI_TOKEN"

# Patterns of the inspected kinds. Word borders are spelt out in
# ASCII because Java's \b follows Unicode letters, and looked for behind the first
# digit because most characters are none.
SENSITIVE_PATTERNS = {
    "imsi": r"[0-9](?<![0-9A-Za-z_][0-9])[0-9]{13,14}(?![0-9A-Za-z_])",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "ipv4": r"[0-9](?<![0-9A-Za-z_][0-9])[0-9]{0,2}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z_])",
}


def _wrap(body: Column, prefix: str) -> Column:
    return F.concat(
        F.lit(f"{prefix}("), F.length(body).cast("string"), F.lit("):"), body
    )


def tokenize(value: Column, key: bytes, prefix: str = TOKEN_PREFIX) -> Column:
    """Deterministic reversible token: AES-CBC with an IV derived from key and value."""
    key_col = F.lit(key)
    seed = F.sha2(F.concat(key_col, F.encode(value, "UTF-8")), 256)
    iv = F.substring(F.unhex(seed), 1, 16)
    sealed = F.aes_encrypt(value, key_col, F.lit("CBC"), F.lit("PKCS"), iv)
    return F.when(value.isNotNull(), _wrap(F.base64(sealed), prefix))


def detokenize(token: Column, key: bytes) -> Column:
    """The value `tokenize` was given."""
    body = F.regexp_replace(token, r"\A[^(]*\([0-9]+\):", "")
    opened = F.aes_decrypt(F.unbase64(body), F.lit(key), F.lit("CBC"), F.lit("PKCS"))
    return opened.cast("string")


def _derived(key: bytes, use: bytes) -> bytes:
    return hmac.digest(key, use, "sha256")


def _keyed_digest(message: Column, key: bytes) -> Column:
    """HMAC-SHA-256 of a binary column."""
    inner, outer = (bytes(b ^ pad for b in key.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(F.lit(inner), message), 256))
    return F.unhex(F.sha2(F.concat(F.lit(outer), first), 256))


def _synthetic_iv(value: Column, key: bytes, context: Column) -> Column:
    """12 bytes of a keyed digest over context and value, unambiguous where one ends and the other begins."""
    bound = F.encode(context, "UTF-8")
    length = F.unhex(F.lpad(F.hex(F.octet_length(bound).cast("bigint")), 16, "0"))
    message = F.concat(length, bound, F.encode(value, "UTF-8"))
    return F.substring(_keyed_digest(message, _derived(key, b"iv")), 1, 12)


def seal(value: Column, key: bytes, context: Column | str = "", prefix: str = TOKEN_PREFIX) -> Column:
    """Deterministic authenticated token: AES-GCM with an IV derived from key, context and value.

    Equal values of equal contexts have equal tokens. `context` is authenticated, not stored: a token that was
    changed, or moved to another context, is not opened. Keys of any length; a null value or context gives null.
    """
    context = F.lit(context) if isinstance(context, str) else context
    sealed = F.aes_encrypt(
        value,
        F.lit(_derived(key, b"seal")),
        F.lit("GCM"),
        F.lit("DEFAULT"),
        _synthetic_iv(value, key, context),
        context,
    )
    return F.when(value.isNotNull() & context.isNotNull(), _wrap(F.base64(sealed), prefix))


def unseal(token: Column, key: bytes, context: Column | str = "") -> Column:
    """The value `seal` was given; null where token, key or context is another."""
    context = F.lit(context) if isinstance(context, str) else context
    body = F.try_to_binary(F.regexp_extract(token, r"\A[^(]*\([0-9]+\):(.*)\z", 1), F.lit("base64"))
    opened = F.try_aes_decrypt(body, F.lit(_derived(key, b"seal")), F.lit("GCM"), F.lit("DEFAULT"), context)
    value = opened.cast("string")
    return F.when(F.substring(body, 1, 12) == _synthetic_iv(value, key, context), value)


def tokenize_one_way(value: Column, key: str, prefix: str = TOKEN_PREFIX) -> Column:
    """Keyed SHA-256 token that cannot be turned back."""
    body = F.sha2(F.concat(F.lit(f"{key}:"), value), 256)
    return F.when(value.isNotNull(), _wrap(body, prefix))


def tokenize_columns(
    df: DataFrame,
    columns: tuple[str, ...] | list[str],
    key: bytes | None,
    prefix: str = TOKEN_PREFIX,
    sealed: bool = False,
) -> DataFrame:
    """Tokenise the named columns; without a key the input comes back unchanged.

    `sealed` tokens are authenticated, with the column's name as their context.
    """
    if key is None:
        return df
    if sealed:
        return df.withColumns({c: seal(F.col(c), key, c, prefix) for c in columns})
    return df.withColumns({c: tokenize(F.col(c), key, prefix) for c in columns})


# Text without this character holds none of the kind.
_NEEDED = {"email": "@", "ipv4": "."}


def count_sensitive(text: Column, kind: str, pattern: str) -> Column:
    """Matches of the pattern; the regex is skipped where it cannot match."""
    count = F.regexp_count(text, F.lit(pattern))
    if kind in _NEEDED:
        count = F.when(F.contains(text, F.lit(_NEEDED[kind])), count)
    return F.coalesce(count, F.lit(0))


def inspect_columns(
    df: DataFrame,
    columns: list[str] | tuple[str, ...],
    kinds: dict[str, str] | None = None,
) -> DataFrame:
    """Adds `<column>_<kind>_count`: how many sensitive values the text holds."""
    kinds = kinds or SENSITIVE_PATTERNS
    return df.withColumns(
        {
            f"{c}_{kind}_count": count_sensitive(F.col(c), kind, pattern)
            for c in columns
            for kind, pattern in kinds.items()
        }
    )


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, start, end, value) of the matches, in code points from 0."""
    between, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def add(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["between"])
        end = start + F.length(pair["value"])
        one = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(so_far["found"], F.array(one)).alias("found"))

    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(values)),
        values,
        lambda b, v: F.struct(b.alias("between"), v.alias("value")),
    )
    begin = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(pairs, begin, add, lambda so_far: so_far["found"])
    needed = F.contains(text, F.lit(_NEEDED[kind])) if kind in _NEEDED else F.regexp_like(text, F.lit(pattern))
    return F.when(needed, found).otherwise(empty)


def check_digit_holds(digits: Column) -> Column:
    """Whether the last digit is the check digit (Luhn) of those before it."""
    places = F.transform(F.reverse(F.split(digits, "")), lambda d, i: d.cast("int") * (1 + i % 2))
    total = F.aggregate(places, F.lit(0), lambda n, d: n + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def findings(text: Column, kinds: dict[str, str] | None = None) -> Column:
    """Array of (kind, start, end, value, check_digit) of the sensitive values in a text, in order.

    Where findings of several kinds overlap, the longest stays (of equal ones the first, then the first kind
    by name). `check_digit` is whether it holds for numbers of 15 digits, null for all else. Null text has none.
    """
    kinds = kinds or SENSITIVE_PATTERNS
    all_ = F.concat(*[_found(F.coalesce(text, F.lit("")), kind, pattern) for kind, pattern in sorted(kinds.items())])

    def rank(x: Column) -> Column:
        return F.struct(x["start"] - x["end"], x["start"], x["kind"])

    def beaten(x: Column) -> Column:
        return F.exists(all_, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & (rank(y) < rank(x)))

    def checked(x: Column) -> Column:
        check = F.when(x["value"].rlike("^[0-9]{15}$"), check_digit_holds(x["value"]))
        return F.struct(*[x[c].alias(c) for c in ("start", "end", "kind", "value")], check.alias("check_digit"))

    return F.array_sort(F.transform(F.filter(all_, lambda x: ~beaten(x)), checked))


def find_sensitive(df: DataFrame, column: str, kinds: dict[str, str] | None = None) -> DataFrame:
    """A row for each finding in `column`: the other columns of the row, then the finding."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.inline(findings(F.col(column), kinds)))


def serialized_bytes(columns: list[str]) -> Column:
    """Bytes of a row with every value as text, nulls counting nothing."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return total
