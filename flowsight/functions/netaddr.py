"""IPv4 predicates and arithmetic as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one decimal octet without leading zeros.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"

# Fixed value: prefix length of mask 255.255.252.0.
DEFAULT_MASK_BITS = 22


def is_ipv4(ip: Column) -> Column:
    """True for four octets 0..255; null counts as false."""
    return F.coalesce(ip.rlike(IPV4_PATTERN), F.lit(False))


def ip_to_long(ip: Column) -> Column:
    """Dotted quad as bigint, null when an octet is missing or out of range."""
    octets = [F.get(F.split(ip, r"\."), F.lit(i)).try_cast("bigint") for i in range(4)]
    in_range = F.lit(True)
    for octet in octets:
        in_range = in_range & octet.between(0, 255)
    total = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(in_range, total)


def long_to_ip(number: Column) -> Column:
    return F.concat_ws(
        ".",
        *[
            F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string")
            for shift in (24, 16, 8, 0)
        ],
    )


def cidr_signature(ip: Column, mask_bits: int = DEFAULT_MASK_BITS) -> Column:
    """The address itself with the prefix length: 12.0.1.2 -> 12.0.1.2/22."""
    return F.concat(ip, F.lit(f"/{mask_bits}"))


def network_cidr(ip: Column, mask_bits: int = DEFAULT_MASK_BITS) -> Column:
    """The network of the address: 12.0.1.2 -> 12.0.0.0/22."""
    mask = (0xFFFFFFFF << (32 - mask_bits)) & 0xFFFFFFFF
    base = ip_to_long(ip).bitwiseAND(F.lit(mask).cast("bigint"))
    return F.when(
        base.isNotNull(), F.concat(long_to_ip(base), F.lit(f"/{mask_bits}"))
    )


def subnet(ip: Column, form: str = "address", mask_bits: int = DEFAULT_MASK_BITS) -> Column:
    if form == "address":
        return cidr_signature(ip, mask_bits)
    if form == "network":
        return network_cidr(ip, mask_bits)
    raise ValueError(f"unknown subnet form {form!r}")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _key_of_groups(groups: Column) -> Column:
    """The 16 bytes of eight hexadecimal groups, null for anything else."""
    good = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-fA-F]{1,4}$"))
    return F.when(good, F.unhex(F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")))


def _wide_key(ip: Column) -> Column:
    halves = F.transform(F.split(ip, "::", 3), lambda h: F.filter(F.split(h, ":", 9), lambda g: g != ""))

    def filled(parts: Column) -> Column:
        first, second = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.array().cast("array<string>"))
        gap = F.when(F.size(parts) == 2, F.lit(8) - F.size(first) - F.size(second)).otherwise(0)
        whole = F.concat(first, F.array_repeat(F.lit("0"), gap), second)
        return F.when(F.size(parts) <= 2, _bound(whole, _key_of_groups))

    return F.when(~ip.rlike("(^:[^:])|([^:]:$)|(:::)"), _bound(halves, filled))


def ip_key(ip: Column) -> Column:
    """An address as 16 bytes that sort like it: IPv4 below 12 zero bytes, IPv6 also with `::`.

    Null for anything else, such as an IPv6 address with a dotted end. Each step is computed once for a row: written
    out flat, the address would be taken apart again wherever a later step names an earlier one.
    """

    def key(a: Column) -> Column:
        return F.when(is_ipv4(a), F.unhex(F.lpad(F.hex(ip_to_long(a)), 32, "0"))).otherwise(_wide_key(a))

    return _bound(ip, key)
