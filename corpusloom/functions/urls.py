"""URL columns: parts, filters, and shard owners. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_URL_BYTES = 256
_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"

#: Namespaces and query fragments of pages that are not articles.
NON_ARTICLE_NAMESPACES = ("Book:", "Category:", "Draft:", "File:", "Help:", "Help_talk:", "MOS:", "Portal:", "Portal_talk:", "Special:", "Talk:", "Template:", "User:", "User_talk:", "Wikipedia:", "Wikipedia_talk:")
NON_ARTICLE_QUERIES = ("Special:", "action=", "curid=", "diff=", "feed=", "oldid=", "printable=yes", "returnto=", "useskin=")


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def url_host(url: Column) -> Column:
    """The lower-case host without user and port; '' where there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(url, _PARTS, 2), r"^[^@]*@", ""), r":[0-9]*$", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def url_query(url: Column) -> Column:
    """The query without its mark, null where there is none."""
    q = F.regexp_extract(url, _PARTS, 4)
    return F.when(q != "", F.substring(q, 2, 1 << 30))


def url_fragment(url: Column) -> Column:
    f = F.regexp_extract(url, _PARTS, 5)
    return F.when(f != "", F.substring(f, 2, 1 << 30))


def parse_domain_list(value: str) -> list[str]:
    """A comma-separated allow-list: trimmed, empty items dropped."""
    return [x.strip() for x in value.split(",") if x.strip()]


def domain_allowed(url: Column, domains: Iterable[str]) -> Column:
    """Exact host equality; an empty list allows nothing, and neither hostless nor IP-address URLs pass."""
    wanted = sorted({d.lower() for d in domains})
    host = url_host(url)
    is_ip = host.rlike(r"^[0-9.]+$") | host.startswith("[")
    return F.coalesce(host.isin(wanted) & (host != "") & ~is_ip, F.lit(False)) if wanted else F.lit(False)


def url_fits(url: Column, max_bytes: int = MAX_URL_BYTES) -> Column:
    return F.coalesce(F.octet_length(url) <= max_bytes, F.lit(False))


def is_article_url(url: Column) -> Column:
    """https, no fragment, below /wiki/, in no service namespace, and without a service query."""
    article = F.regexp_extract(url_path(url), r"^/wiki/(.*)$", 1)
    fine = (url_scheme(url) == "https") & (F.regexp_extract(url, _PARTS, 5) == "") & url_path(url).startswith("/wiki/")
    query = F.coalesce(url_query(url), F.lit(""))
    for n in NON_ARTICLE_NAMESPACES:
        fine &= ~article.startswith(n)
    for q in NON_ARTICLE_QUERIES:
        fine &= ~query.contains(q)
    return F.coalesce(fine, F.lit(False))


UrlPredicate = Callable[[Column], Column]


def all_of(*predicates: UrlPredicate) -> UrlPredicate:
    """A predicate that holds where all do; none of them: holds everywhere."""

    def both(url: Column) -> Column:
        out = F.lit(True)
        for p in predicates:
            out &= p(url)
        return out

    return both


def hash_shard(url: Column, shards: int) -> Column:
    """Owner by the first 60 bits of the whole URL's MD5, which any other system can tell too."""
    return F.pmod(F.conv(F.substring(F.md5(url.cast("binary")), 1, 15), 16, 10).cast("bigint"), F.lit(max(1, shards))).cast("int")


def _letter(c: Column) -> Column:
    first = F.regexp_extract(c, r"[A-Za-z]", 0)
    return F.when(first != "", F.ascii(F.upper(first)) - 65)


def title_bucket(url: Column, buckets: int, with_namespace: bool = False) -> Column:
    """Bucket of an encyclopedia page by its title's first ASCII letter (and its namespace's); null for any other URL."""
    slug = F.regexp_extract(url_path(url), r"^/wiki/(.*)$", 1)
    cut = F.instr(slug, ":")
    has_ns = F.lit(with_namespace) & (cut > 0) & (F.length(slug) > cut)
    rest = F.when(has_ns, slug.substr(cut + 1, F.length(slug))).otherwise(slug)
    ns = F.when(has_ns, slug.substr(F.lit(1), cut - 1))
    bucket = _letter(rest) + F.coalesce((_letter(ns) + 1) * 32, F.lit(0))
    known = url_host(url).contains("wikipedia.org") & url_path(url).startswith("/wiki/")
    return F.when(known, F.pmod(bucket, F.lit(max(1, buckets)))).cast("int")


def shard_owner(url: Column, shards: int, buckets: int = 26, with_namespace: bool = False) -> Column:
    """Owner by title bucket, by hash where there is none."""
    return F.coalesce(F.pmod(title_bucket(url, buckets, with_namespace), F.lit(max(1, shards))), hash_shard(url, shards)).cast("int")


def repair_url(url: Column) -> Column:
    """url as a lenient parser reads it: trimmed, tabs and line ends taken out, blanks and quotes encoded, backslashes of the path turned."""
    bare = F.replace(F.trim(F.regexp_replace(url, r"[\t\r\n]", "")), F.lit("\\"), F.lit("/"))
    return F.replace(F.replace(F.replace(F.replace(bare, F.lit(" "), F.lit("%20")), F.lit('"'), F.lit("%22")), F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E"))


def join_url(base: Column, href: Column) -> Column:
    """href resolved against base: whole URLs, //host, /path, ?query, #fragment, and paths beside the base's. Null if either is.

    Segments . and .. are taken out. Where the base has no scheme and host, only whole URLs resolve; others are null.
    """
    root = F.concat(url_scheme(base), F.lit("://"), F.regexp_extract(base, _PARTS, 2))
    folder = F.regexp_extract(url_path(base), r"^(.*/)[^/]*$", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substring(href, F.length(path) + 1, F.lit(1 << 30))
    full = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    steps = F.split(full, "/")
    push = lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
    clean = F.aggregate(steps, F.array().cast("array<string>"), push)
    clean = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(clean, F.array(F.lit("")))).otherwise(clean)
    query = F.coalesce(F.concat(F.lit("?"), url_query(base)), F.lit(""))
    own_path = F.when(url_path(base) == "", F.lit("/")).otherwise(url_path(base))
    joined = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(url_host(base) == "", F.lit(None).cast("string"))
        .when(href.startswith("//"), F.concat(url_scheme(base), F.lit(":"), href))
        .when(href == "", F.concat(root, own_path, query))
        .when(href.startswith("#"), F.concat(root, own_path, query, href))
        .when(href.startswith("?"), F.concat(root, own_path, href))
        .otherwise(F.concat(root, F.array_join(clean, "/"), tail))
    )
    return F.when(base.isNotNull(), joined)
