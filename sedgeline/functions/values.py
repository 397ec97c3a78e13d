"""Scalar values: scaled decimals, rates, waits, URLs, decoded payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_value(value: Column, scale: Column) -> Column:
    """value * 10**scale; not-a-number for text that is no number."""
    return F.coalesce(value.try_cast("double") * F.pow(F.lit(10.0), scale.cast("double")), F.lit(float("nan")))


def scaled_text(value: Column, scale: Column, mode: str) -> Column:
    """A scaled decimal as `json_string`, as `structured` (a struct) or as `calculated` number, always text but for the struct."""
    if mode == "structured":
        return F.struct(scale.cast("long").alias("scale"), value.cast("string").alias("value"))
    if mode == "calculated":
        return scaled_value(value, scale).cast("string")
    return F.to_json(F.struct(scale.cast("long").alias("scale"), value.cast("string").alias("value")))


def success_rate(done: Column, skipped: Column) -> Column:
    """Per cent done; 100 of nothing."""
    total = done + skipped
    return F.when(total == 0, F.lit(100.0)).otherwise(done * 100.0 / F.nullif(total, F.lit(0)))


def retry_wait(attempt: Column, retry_after: Column | None = None, *, first: float = 2.0, most: float = 60.0) -> Column:
    """Seconds before the next try: what the server asks for, else doubling up to a bound."""
    own = F.least(F.lit(first) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))
    return own if retry_after is None else F.coalesce(retry_after.cast("double"), own)


def decoded(payload: Column) -> Column:
    """A base64 payload as text; null where it is not base64 of UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(payload, F.lit("base64")).cast("string"))


def encoded(text: Column) -> Column:
    return F.base64(F.encode(text, "UTF-8"))


# The ranges of addresses that are not public.
PRIVATE_V4 = ["0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "192.0.0.0/24", "192.0.2.0/24", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4"]
LOCAL_NAMES = ("localhost", "localhost.localdomain", "ip6-localhost", "ip6-loopback")
ONTOLOGY_HOSTS = ("w3.org", "purl.org", "schema.org", "xmlns.com", "github.com", "raw.githubusercontent.com")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))


def port_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*):(\d+)", 1).try_cast("int")


def is_private_host(host: Column) -> Column:
    """Literal addresses in a private range; names are not resolved."""
    quad = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    parts = F.split(host, r"\.")
    number = sum((F.get(parts, F.lit(k)).try_cast("long") * (256 ** (3 - k)) for k in range(1, 4)), F.get(parts, F.lit(0)).try_cast("long") * 256**3)
    inside = F.lit(False)
    for block in PRIVATE_V4:
        base, bits = block.split("/")
        size = 1 << (32 - int(bits))
        low = sum(int(x) << (24 - 8 * k) for k, x in enumerate(base.split(".")))
        inside = inside | number.between(low, low + size - 1)
    six = host.rlike(r"^\[(::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|ff[0-9a-f]{2}:.*|::ffff:(0|10|127|169\.254|172\.(1[6-9]|2\d|3[01])|192\.168)\..*)\]$")
    return F.coalesce(F.when(quad, inside).otherwise(six), F.lit(False))


def url_fault(url: Column, *, schemes: tuple[str, ...] = ("https",), hosts: tuple[str, ...] | None = None, ports: tuple[int, ...] = (443, 8443)) -> Column:
    """Why a URL is refused: the first of empty, scheme, host, local, domain, port, private; null if it is allowed."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host, port = host_of(url), port_of(url)
    out = F.when(F.coalesce(F.trim(url), F.lit("")) == "", "empty").when(~scheme.isin(*schemes), "scheme").when(host == "", "host").when(host.isin(*LOCAL_NAMES), "local")
    if hosts is not None:
        own = F.lit(False)
        for h in hosts:
            own = own | (host == h) | F.endswith(host, F.lit("." + h))
        out = out.when(~own, "domain")
    return out.when(port.isNotNull() & ~port.isin(*ports), "port").when(is_private_host(host), "private")


def ontology_url_fault(url: Column) -> Column:
    return url_fault(url, schemes=("https", "http"), hosts=ONTOLOGY_HOSTS, ports=(80, 443, 8443))


def is_url(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/\s]+"), F.lit(False))


def loggable_url(url: Column) -> Column:
    """Without user, query and fragment."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@", "$1")
