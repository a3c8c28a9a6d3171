"""URL, host and domain functions, and the predicates built on them."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, functions as F

from newsflow import settings
from newsflow.functions.text import clean_key, matches_any, strip

_AUTHORITY = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)"
_SPACE = r"[\s\x1c-\x1f]*"
_HOST = (
    rf"(?iU)^{_SPACE}(?:(?:[a-z][a-z0-9+.-]*:)?//(?=[^/?#]))?{_SPACE}(?:www\.)?([^/?#]*?){_SPACE}(?:[/?#]|$)"
)
_DOMAIN = r"^(?:https?://)?(?:www\.)?([^/]+)"
_ARCHIVE_PATH = r"crawl-data/CC-NEWS/(\d{4})/(\d{2})/(.+)$"  # fixed public layout

_UNKNOWN = settings.DEFAULT_DOMAIN


def _or_unknown(col: Column) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(_UNKNOWN))


def netloc(url: Column) -> Column:
    """Authority part as written; empty where there is none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def netloc_or_unknown(url: Column) -> Column:
    return _or_unknown(netloc(url))


def strip_www(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def domain_from_url(url: Column) -> Column:
    """Lower-case host with port and user info, without one leading ``www.``.

    One pattern does it: optional scheme and slashes, if a host follows them,
    then everything up to the path, without white space around.
    """
    return _or_unknown(F.lower(F.regexp_extract(url, _HOST, 1)))


def domain_pattern(url: Column, lower: bool = False) -> Column:
    """Host by pattern only: keeps case unless asked, and a query without path."""
    domain = _or_unknown(F.regexp_extract(url.cast("string"), _DOMAIN, 1))
    return F.lower(domain) if lower else domain


def domain_or_host(domain: Column, url: Column) -> Column:
    """The given domain lowered, or the host of the URL where none is given."""
    return F.when(domain.isNull() | (F.length(domain) == 0), domain_from_url(url)).otherwise(F.lower(domain))


def _host(url_or_host: Column) -> Column:
    return F.when(url_or_host.contains("://"), domain_from_url(url_or_host)).otherwise(clean_key(url_or_host))


def registrable_part(host: Column) -> Column:
    """The part of a lower-case host that is registered: a label and the public suffix."""
    by_labels: dict[int, list[str]] = defaultdict(list)
    for suffix in settings.MULTI_PART_SUFFIXES:
        by_labels[suffix.count(".") + 1].append(suffix)
    result = F.substring_index(host, ".", -2)
    for labels, suffixes in by_labels.items():
        pattern = "(?:" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"
        result = F.when(host.rlike(pattern), F.substring_index(host, ".", -labels)).otherwise(result)
    return result


def registrable_domain(url_or_host: Column) -> Column:
    """Registered part of a URL's or a plain host."""
    return registrable_part(strip_www(_host(url_or_host)))


def host_matches(host: Column, domain: Column) -> Column:
    """Host equals the domain or lies below it."""
    h, d = strip_www(clean_key(host)), clean_key(domain)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


def host_in_allow_list(host: Column, allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS) -> Column:
    """Strict allow-list: an entry is the host or one of its parent domains.

    Entries are grouped by their number of labels, so each group costs one
    hash lookup of the host's tail, however long the list is.
    """
    by_labels: dict[int, set[str]] = defaultdict(set)
    for entry in allowed:
        entry = entry.lower().strip().removeprefix("www.")
        by_labels[entry.count(".") + 1].add(entry)
    hit = F.lit(False)
    for labels, entries in sorted(by_labels.items()):
        hit = hit | F.substring_index(host, ".", -labels).isin(*sorted(entries))
    return F.coalesce(hit, F.lit(False))


def in_allow_list(url_or_host: Column, allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS) -> Column:
    """Strict allow-list over URLs or plain hosts."""
    return host_in_allow_list(strip_www(_host(url_or_host)), allowed)


def in_allow_list_loose(url: Column, allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS) -> Column:
    """Loose allow-list: an entry anywhere in the authority. An empty list allows all."""
    if not allowed:
        return F.lit(True)
    return matches_any(F.lower(netloc(url)), allowed)


def mentions_domain(url: Column, allowed: tuple[str, ...] = settings.ALLOWED_DOMAINS) -> Column:
    """An entry anywhere in the whole URL."""
    return matches_any(url, allowed)


def is_article_url(url: Column, denied: tuple[str, ...] = settings.DENIED_URL_PARTS) -> Column:
    return ~matches_any(url, denied)


def _recode(part: Column) -> Column:
    """Decode and re-encode a query component the way HTML forms do."""
    decoded = F.try_url_decode(F.regexp_replace(part, r"%(?![0-9A-Fa-f]{2})", "%25"))
    encoded = F.url_encode(decoded)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_url(url: Column, drop: str = "traffic_source") -> Column:
    """Remove one query parameter; the others keep their order and are re-encoded."""
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    base = F.concat(F.lower(scheme), F.substring(base, F.length(scheme) + 1, F.length(base)))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    coded = F.transform(
        pairs,
        lambda p: F.struct(
            _recode(F.substring_index(p, "=", 1)).alias("k"),
            _recode(F.when(F.instr(p, "=") > 0, F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")).alias(
                "v"
            ),
        ),
    )
    kept = F.filter(coded, lambda p: p["k"] != drop)
    query = F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    return F.concat(
        base,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def archive_year(path: Column) -> Column:
    return _or_unknown(F.regexp_extract(path, _ARCHIVE_PATH, 1))


def archive_month(path: Column) -> Column:
    return _or_unknown(F.regexp_extract(path, _ARCHIVE_PATH, 2))


def archive_file(path: Column) -> Column:
    """Name of the landing file of an archive."""
    return F.replace(F.substring_index(path, "/", -1), F.lit(".warc.gz"), F.lit(".jsonl"))


def own_domains(host: Column) -> Column:
    """Domains that belong to a feed's host: itself, without a feed prefix, and their registered parts."""
    stripped = [
        F.when(host.startswith(p), F.substring(host, F.lit(len(p) + 1), F.length(host)))
        for p in settings.FEED_HOST_PREFIXES
    ]
    hosts = F.array_compact(F.array(host, *stripped))
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.array(h, registrable_part(h)))))


def with_publisher_groups(domains: Column, groups: tuple[tuple[str, ...], ...] = settings.PUBLISHER_GROUPS) -> Column:
    """Add the members of every publisher group one of the domains belongs to.

    A domain belongs to a group whose member it contains; that covers equality
    and subdomains.
    """
    none = F.array().cast("array<string>")
    related = [
        F.when(F.exists(domains, lambda d: matches_any(d, g)), F.array(*[F.lit(m) for m in g])).otherwise(none)
        for g in groups
    ]
    return F.array_union(domains, F.flatten(F.array(*related))) if groups else domains


def link_matches(host: Column, registered: Column, domains: Column) -> Column:
    """Does a link's host lie in one of the expected domains?"""
    return F.exists(domains, lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)) | (registered == d))
