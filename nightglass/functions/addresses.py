"""IP addresses as text, and networks as ranges of comparable values."""

from __future__ import annotations

import ipaddress

# An IPv4 address with octets up to 255.
OCTET = "(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IPV4 = f"{OCTET}([.]{OCTET}){{3}}"
# Groups and at most one gap; the number of groups is counted apart.
IPV6 = f"([0-9a-f]{{1,4}}:)*([0-9a-f]{{1,4}})?(::)?([0-9a-f]{{1,4}}:)*([0-9a-f]{{1,4}}|{IPV4})?"


def ipv4_number_sql(source: str) -> str:
    """The 32-bit number of an address; NULL or nonsense for other text, so test the shape as well."""
    octets = " + ".join(f"try_cast(split_part({source}, '.', {i + 1}) as bigint) * {256 ** (3 - i)}" for i in range(4))
    return f"({octets})"


def ipv6_key_sql(source: str) -> str:
    """32 hex digits that order as the 128-bit address does; NULL for text that is no IPv6 address.

    A gap (::) is filled up with zero groups, a dotted tail counts as two groups, letters of either case are equal.
    """
    tail = f"regexp_extract(a, '(^|:)({IPV4})$', 2)"
    hexed = f"lpad(lower(hex({ipv4_number_sql(tail)})), 8, '0')"
    dotted = f"if(contains(a, '.'), concat(left(a, length(a) - length({tail})), left({hexed}, 4), ':', right({hexed}, 4)), a)"
    groups = lambda half: f"filter(split({half}, ':'), g -> g <> '')"
    padded = lambda half: f"array_join(transform({groups(half)}, g -> lpad(g, 4, '0')), '')"
    left, right = "split_part(b, '::', 1)", "split_part(b, '::', 2)"
    count = f"(size({groups(left)}) + size({groups(right)}))"
    filled = f"concat({padded(left)}, repeat('0000', 8 - {count}), {padded(right)})"
    real = f"if(contains(b, '::'), {count} < 8, {count} = 8)"
    shaped = f"a rlike '^{IPV6}$' and contains(a, ':') and not a rlike '[^:]:$|^:[^:]|::.*::|:::'"
    key = f"get(transform(array({dotted}), b -> if({real}, {filled}, null)), 0)"
    return f"get(transform(array(lower({source})), a -> if({shaped}, {key}, null)), 0)"


def in_network_sql(source: str, network: str) -> str:
    """True for an address of that network and family, as text; else false or NULL."""
    net = ipaddress.ip_network(network, strict=False)
    if net.version == 4:
        low, high = int(net.network_address), int(net.broadcast_address)
        return f"({source} rlike '^{IPV4}$' and {ipv4_number_sql(source)} between {low} and {high})"
    low, high = (f"{int(a):032x}" for a in (net.network_address, net.broadcast_address))
    return f"({ipv6_key_sql(source)} between '{low}' and '{high}')"
