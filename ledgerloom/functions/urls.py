"""URL functions (P29–P39): Catalyst expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import policy as P
from . import emails
from .text import fold, slug, strip

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:([^/?#@]*)@)?(\[[^\]]*\]|[^/?#:@]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
_PARTS = ("scheme", "credentials", "host", "port", "path", "query", "fragment")


def let(value: Column, use) -> Column:
    """use(value), the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _part(u: Column, group: int) -> Column:
    """1 scheme, 2 credentials, 3 host, 4 port, 5 path, 6 query, 7 fragment of an absolute URL ('' where absent)."""
    return F.regexp_extract(u, _URL, group)


def _parts(u: Column) -> Column:
    """All parts, scheme and host in lower case, the path at least '/', the port '' if it is the scheme's own."""
    raw = {n: _part(u, k) for k, n in enumerate(_PARTS, 1)}
    raw |= {"scheme": F.lower(raw["scheme"]), "host": F.lower(raw["host"]), "path": F.when(raw["path"] == "", "/").otherwise(raw["path"])}
    raw["port"] = F.when(F.concat_ws(":", raw["scheme"], raw["port"]).isin("https:443", "http:80"), "").otherwise(raw["port"])
    return F.struct(*[c.alias(n) for n, c in raw.items()])


def host(u: Column) -> Column:
    return F.lower(_part(u, 3))


def bare_host(u: Column) -> Column:
    return F.regexp_replace(host(u), "^www[.]", "")


def _bare(h: Column) -> Column:
    return F.regexp_replace(h, "^www[.]", "")


def _dots(path: Column) -> Column:
    """The path with . and .. segments resolved."""

    def walk(parts: Column) -> Column:
        start = F.array().cast("array<string>")
        kept = F.aggregate(parts, start, lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.array_append(acc, s)))
        return let(kept, lambda k: F.concat(F.lit("/"), F.array_join(k, "/"), F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(k) > 0), "/").otherwise("")))

    return F.when(path.rlike("(^|/)[.]{1,2}(/|$)"), let(F.split(F.substr(path, F.lit(2)), "/", -1), walk)).otherwise(path)


def _encoded(path: Column) -> Column:
    """The path with blanks and characters beyond ASCII percent-encoded as UTF-8; escapes that are there stay."""
    each = F.transform(F.split(path, ""), lambda c: F.when(c.rlike(r"[^\x21-\x7e]|[\"<>`{}]"), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c))
    return F.when(path.rlike(r"[^\x21-\x7e]|[\"<>`{}]"), F.array_join(each, "")).otherwise(path)


def _resolved(href: Column, base: Column, use) -> Column:
    """use(parts of href made absolute, parts of base); null unless both are http(s) with a host."""

    def join(h: Column, b: Column) -> Column:
        origin = F.concat(b["scheme"], F.lit("://"), F.when(b["credentials"] != "", F.concat(b["credentials"], F.lit("@"))).otherwise(""), b["host"], F.when(b["port"] != "", F.concat(F.lit(":"), b["port"])).otherwise(""))
        return (
            F.when(h.rlike("(?i)^https?://"), h)
            .when(h.rlike(_SCHEME), F.lit(None))
            .when(h.startswith("//"), F.concat(b["scheme"], F.lit(":"), h))
            .when(h.startswith("/"), F.concat(origin, h))
            .when((h == "") | h.startswith("#"), F.concat(origin, b["path"], b["query"], h))
            .when(h.startswith("?"), F.concat(origin, b["path"], h))
            .otherwise(F.concat(origin, F.regexp_extract(b["path"], "^(.*/)", 1), h))
        )

    def inner(b: Column) -> Column:
        joined = let(F.regexp_replace(href, r"^\s+|\s+$", ""), lambda h: join(h, b))
        return let(joined, lambda u: let(_parts(u), lambda p: F.when(b["scheme"].isin("http", "https") & (p["host"] != ""), use(p, b))))

    return let(_parts(base), inner)


def _port(p: Column) -> Column:
    return F.when(p["port"] != "", F.concat(F.lit(":"), p["port"])).otherwise("")


def resolve(href: Column, base: Column) -> Column:
    """href made absolute against base, dot segments resolved; null unless http(s) with a host."""
    credentials = lambda p: F.when(p["credentials"] != "", F.concat(p["credentials"], F.lit("@"))).otherwise("")
    return _resolved(href, base, lambda p, b: F.concat(p["scheme"], F.lit("://"), credentials(p), p["host"], _port(p), _dots(p["path"]), p["query"], p["fragment"]))


def canonical(href: Column, base: Column) -> Column:
    """The page of the same site that a link leads to (https, no www, query or fragment), else null."""

    def build(p: Column, b: Column) -> Column:
        path = F.regexp_replace(F.regexp_replace(_encoded(_dots(p["path"])), "/{2,}", "/"), "/$", "")
        return F.when(_bare(p["host"]) == _bare(b["host"]), F.concat(F.lit("https://"), _bare(p["host"]), _port(p), path))

    skip = href.rlike(r"(?i)^\s*((mailto|tel|javascript|data):|#|$)")
    return F.when(~skip, _resolved(href, base, build))


def website(c: Column) -> Column:
    """A site's address as https, no www, query, fragment or trailing slashes; null unless the host is dotted."""

    def build(p: Column) -> Column:
        h = _bare(p["host"])
        return F.when(h.contains(".") & ~h.rlike(r"\s"), F.concat(F.lit("https://"), h, _port(p), F.regexp_replace(p["path"], "/+$", "")))

    address = let(strip(c), lambda t: F.when(t.rlike("(?i)^https?://"), t).when(t != "", F.concat(F.lit("https://"), t)))
    return let(address, lambda u: let(_parts(u), build))


def without_trackers(href: Column, base: Column) -> Column:
    """Scheme, www and query kept, fragment and tracking parameters dropped; null with credentials."""

    def build(p: Column, b: Column) -> Column:
        pairs = F.filter(F.split(F.substr(p["query"], F.lit(2)), "&"), lambda x: ~F.split_part(x, F.lit("="), F.lit(1)).rlike("^utm_|fbclid|gclid") & (x != ""))
        query = let(F.array_join(pairs, "&"), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
        return F.when(p["credentials"] == "", F.concat(p["scheme"], F.lit("://"), p["host"], _port(p), _encoded(_dots(p["path"])), query))

    return _resolved(href, base, build)


def same_site(a: Column, b: Column) -> Column:
    """P32."""
    return F.coalesce((bare_host(a) == bare_host(b)) & (bare_host(a) != ""), F.lit(False))


def is_ipv4(c: Column) -> Column:
    return c.rlike("^((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])([.]|$)){4}$") & ~c.endswith(".")


def public_ip(c: Column) -> Column:
    """Whether an address is a public one; anything else is not."""
    a, b = (F.split_part(c, F.lit("."), F.lit(k)).try_cast("int") for k in (1, 2))
    special = (
        a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & b.isin(0, 168))
        | ((a == 100) & b.between(64, 127)) | ((a == 198) & b.isin(18, 19))
    )
    six = F.lower(c)
    v6 = six.rlike("^[23][0-9a-f]{3}:[0-9a-f:]*$") & ~six.startswith("2001:db8:") & ~six.startswith("2002:")
    return F.coalesce(F.when(is_ipv4(c), ~special).otherwise(v6), F.lit(False))


def unsafe_reason(u: Column) -> Column:
    """Why a URL must not be fetched, null if it may."""
    h = F.regexp_replace(host(u), r"^\[|\]$", "")
    ip = is_ipv4(h) | h.contains(":")
    return (
        F.when(u.isNull() | ~u.rlike("(?i)^https?://") | (_part(u, 2) != "") | ~_part(u, 4).isin("", "80", "443") | (h == ""), "UNSAFE_URL")
        .when(~h.contains(".") & ~ip, "UNSAFE_HOST")
        .when(ip & ~public_ip(h), "PRIVATE_ADDRESS")
        .when(h.rlike("(^|[.])(localhost|local|internal|home|test|invalid)$"), "PRIVATE_HOST")
    )


def public_http(u: Column) -> Column:
    """A public http(s) address by its form alone."""
    h = host(u)
    bad = h.rlike(r"^\[|^[0-9]+([.][0-9]+){3}$|(^|[.])localhost$|[.](local|internal|test|invalid)$")
    return F.coalesce(u.rlike("(?i)^https?://") & (_part(u, 2) == "") & h.contains(".") & ~bad, F.lit(False))


def classic_score(url: Column, label: Column) -> Column:
    """Weights of all terms in the slug (overlapping ones add up) less the depth beyond 3; no URL: 100 less."""

    def weigh(text: Column) -> Column:
        total = F.lit(0)
        for term, points in P.LINK_TERMS:
            total = total + F.when(text.contains(term), points).otherwise(0)
        return total

    depth = F.size(F.filter(F.split(_part(url, 5), "/"), lambda s: s != ""))
    ok = url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/]")
    return F.coalesce(let(slug(F.concat_ws(" ", url, label)), weigh) + F.when(ok, -F.greatest(depth - 3, F.lit(0))).otherwise(-100), F.lit(-100)).cast("long")


def batch_score(url: Column, label: Column) -> Column:
    """Points of pattern groups; files exactly -50; no URL -100."""

    def weigh(text: Column) -> Column:
        total = F.lit(0)
        for pattern, points in P.LINK_PATTERNS:
            total = total + F.when(text.rlike(pattern), points).otherwise(0)
        return total

    def score(path: Column) -> Column:
        text = fold(F.concat_ws(" ", F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path), F.coalesce(label, F.lit(""))))
        return F.when(path.rlike(P.LINK_FILES), -50).otherwise(let(text, weigh))

    ok = F.coalesce(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/]"), F.lit(False))
    return F.when(~ok, -100).otherwise(let(_part(url, 5), score)).cast("long")


def candidates(website_col: Column, mails: Column, policy: str = "batch") -> Column:
    """P38 (batch: own site, then https://h and https://www.h, first four), P39 (classic: distinct non-freemail sites)."""
    if P.check(policy) == "classic":
        hosts = F.transform(F.coalesce(mails, F.array().cast("array<string>")), lambda e: F.when(~emails.is_freemail(emails.domain(e), "classic"), website(emails.domain(e))))
        return F.array_distinct(F.array_compact(hosts))
    hosts = F.transform(F.coalesce(mails, F.array().cast("array<string>")), lambda e: F.lower(F.split_part(e, F.lit("@"), F.lit(2))))
    usable = F.filter(hosts, lambda h: h.rlike("^[a-z0-9.-]+[.][a-z]{2,}$") & ~h.isin(*P.FREEMAIL["batch"]))
    derived = F.flatten(F.transform(usable, lambda h: F.array_compact(F.array(F.concat(F.lit("https://"), h), F.when(~h.startswith("www."), F.concat(F.lit("https://www."), h))))))
    return F.slice(F.array_distinct(F.concat(F.array_compact(F.array(F.nullif(website_col, F.lit("")))), derived)), 1, 4)
