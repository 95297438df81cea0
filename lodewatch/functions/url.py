"""URL keys, ids and predicates as Column expressions; no UDF and no ``parse_url`` (which fails on odd input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must be these for keys and choices to agree with existing tables.
TRACKING = r"(?iu)^(utm_|fbclid|gclid|mc_|_hs|ref$)"
DOCUMENT_ID_QUERY = r"(?iu)\b(document|edition|asset|media|file)[-_]?id="
REPORTISH_PATH = r"(?iu)report|annual|sustainab|esg|/download|/publication|/disclosur|/pdfs?/"
DISCOVERY_PATH = r"(?iu)report|annual|sustainab|esg|/download|/publication|/disclosur"
REPORT_NAME = r"(?iu)annual|sustainab|integrated|\besg\b|\bcsr\b|report|memoria|rapport|informe|bericht|disclosure|statement|20[12]\d"
DOCUMENT_ENDPOINTS = ("/static-files/", "/getattachment/")
FRAMEWORK_HOSTS = (
    "sciencebasedtargets.org", "globalreporting.org", "weps.org", "unglobalcompact.org", "cdp.net", "sasb.org", "ifrs.org",
    "integratedreporting.org", "wbcsd.org", "ghgprotocol.org", "iso.org", "weforum.org", "oecd.org", "ilo.org", "un.org",
    "europa.eu", "tcfdhub.org", "fsb.org", "msci.com", "sustainalytics.com", "ecovadis.com", "ellenmacarthurfoundation.org",
    "fairlabor.org", "bcorporation.net",
)
LATEST_YEAR = 2027
#: Public suffixes of several labels known without a list; others can be passed to ``registrable_domain``.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp", "com.br", "com.cn", "com.hk", "com.sg", "com.tr", "com.mx", "co.in", "co.kr", "co.za", "com.tw", "com.my")


def _tidy(url: Column) -> Column:
    """What a URL splitter sees: no leading controls or blanks, no tab or line end anywhere."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _netloc(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?i:https?)://([^/?#]*)", 1)


def host(url: Column) -> Column:
    """The lower-cased host, without user and port; '' where the URL is not http(s)."""
    return F.lower(F.regexp_replace(F.regexp_replace(_netloc(_tidy(url)), r"^.*@", ""), r":[^:]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(_tidy(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(_tidy(url), r"^[^?#]*\?([^#]*)", 1)


def _sound(url: Column) -> Column:
    """http(s) with a host that is no broken bracket address."""
    u = _tidy(url)
    return u.rlike(r"^(?i:https?)://") & ~_netloc(u).rlike(r"[\[\]]")


def _decoded(text: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _form(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def kept_query(url: Column) -> Column:
    """The query's parameters with a value, without tracking ones, sorted by name and value and encoded again."""
    parts = F.filter(F.split(query(url), "&"), lambda p: p.rlike("(?s)^[^=]*=.+"))
    pairs = F.transform(parts, lambda p: F.struct(F.coalesce(_decoded(F.substring_index(p, "=", 1)), F.lit("")).alias("k"), F.coalesce(_decoded(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)), F.lit("")).alias("v")))
    own = F.array_sort(F.filter(pairs, lambda x: ~x["k"].rlike(TRACKING)))
    return F.array_join(F.transform(own, lambda x: F.concat(_form(x["k"]), F.lit("="), _form(x["v"]))), "&")


def _with_query(front: Column, url: Column) -> Column:
    q = kept_query(url)
    return F.when(query(url) == "", front).otherwise(F.concat(front, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")))


def url_key(url: Column) -> Column:
    """The key by which documents are told apart: no scheme, www, port, fragment, tracking or closing slash, in lower case. NULL if not http(s)."""
    front = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""))
    return F.when(_sound(url), F.lower(_with_query(front, url)))


def url_key_total(url: Column) -> Column:
    """``url_key``, or the trimmed lower-cased text where there is none; never NULL."""
    return F.coalesce(url_key(url), F.lower(strip(url)), F.lit(""))


def url_clean(url: Column) -> Column:
    """A URL that can still be fetched: scheme, host with www, path in its own case, kept query. NULL if not http(s)."""
    front = F.concat(F.lower(F.regexp_extract(_tidy(url), r"^([A-Za-z]+):", 1)), F.lit("://"), host(url), F.regexp_replace(path(url), "/+$", ""))
    return F.when(_sound(url), _with_query(front, url))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def registrable_domain(url: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The host's registrable domain by ``suffixes`` and, beyond them, its last two labels; an address stays whole."""
    h = F.regexp_replace(host(url), r"\.$", "")
    labels = F.split(h, r"\.")
    two = F.substring_index(h, ".", -2)
    return F.when(h.rlike(r"^[0-9.]+$") | (F.size(labels) < 3), h).when(two.isin(*suffixes), F.substring_index(h, ".", -3)).otherwise(two)


def canon_seen(entry: Column) -> Column:
    """A stored link, old key or fetchable URL, as a key; NULL if blank."""
    e = blank_to_null(entry)
    return F.when(e.rlike("^https?://"), url_key(e)).otherwise(e)


def fetchable(entry: Column) -> Column:
    """A stored link as a URL: https:// before a bare key; '' if blank."""
    e = F.coalesce(strip(entry), F.lit(""))
    return F.when(e == "", "").when(e.rlike("^https?://"), e).otherwise(F.concat(F.lit("https://"), e))


def owner(entity: Column) -> Column:
    return F.coalesce(blank_to_null(entity), F.lit("NA"))


def owned_id(owner_name: Column, text: Column, n: int) -> Column:
    """An id from parts that may have been made once a page or document."""
    return F.concat(owner_name, F.lit("-"), F.substring(F.sha1(text), 1, n))


def link_id(entity: Column, url: Column) -> Column:
    return owned_id(owner(entity), url_key_total(url), 8)


def detection_id(entity: Column, page: Column, document: Column) -> Column:
    return owned_id(owner(entity), detection_text(url_key_total(page), url_key_total(document)), 10)


def detection_text(page_key: Column, document_key: Column) -> Column:
    return F.concat(page_key, F.lit("|"), document_key)


def library_id(entity: Column, document: Column) -> Column:
    return owned_id(owner(entity), url_key_total(document), 10)


def is_document_endpoint(lower_path: Column) -> Column:
    one, *more = (lower_path.contains(x) for x in DOCUMENT_ENDPOINTS)
    for x in more:
        one = one | x
    return one


def is_pdf_url(url: Column) -> Column:
    p = F.lower(path(F.substring_index(url, "?", 1)))
    return F.coalesce(p.endswith(".pdf") | is_document_endpoint(p), F.lit(False))


def has_document_id(url: Column) -> Column:
    return query(url).rlike(DOCUMENT_ID_QUERY)


def is_framework_host(host_name: Column, hosts: tuple[str, ...] = FRAMEWORK_HOSTS) -> Column:
    """Whether the host is one of ``hosts`` or lies below one: its endings of two and three labels are looked up."""
    h = F.lower(F.coalesce(host_name, F.lit("")))
    return F.exists(F.array(*map(F.lit, hosts)), lambda s: (h == s) | F.endswith(h, F.concat(F.lit("."), s)))


def year_of(url: Column) -> Column:
    """The latest year 2010 to LATEST_YEAR named anywhere in the URL, as text; '' if none."""
    years = F.filter(F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit("(20[12][0-9])"), F.lit(1)), lambda y: y.cast("int")), lambda y: y <= LATEST_YEAR)
    return F.coalesce(F.array_max(years).cast("string"), F.lit(""))


def looks_like_report(url: Column) -> Column:
    return F.coalesce(F.element_at(F.split(path(F.substring_index(url, "?", 1)), "/"), -1).rlike(REPORT_NAME), F.lit(False))


def filename_for(url: Column, library: Column, longest: int = 120) -> Column:
    """The decoded last path segment as a .pdf name; without one that has a dot, the library id stands in."""
    last = F.element_at(F.split(path(url), "/"), -1)
    name = F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(last, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))), last)
    name = F.when((name == "") | ~name.contains("."), F.concat(F.coalesce(blank_to_null(library), F.lit("document")), F.lit(".pdf"))).otherwise(name)
    whole = F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))
    return F.substring(whole, 1, longest)


def url_join(base: Column, reference: Column) -> Column:
    """A reference resolved against a page's URL: absolute, //host, /path, ?query, #fragment or relative with dot segments."""
    r = _tidy(reference)
    b = _tidy(base)
    site = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    base_path = path(b)
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    tail = F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
    merged = F.concat(F.when(F.startswith(r, F.lit("/")), F.lit("")).otherwise(F.when(folder == "", "/").otherwise(folder)), F.regexp_extract(r, r"^([^?#]*)", 1))
    return (
        F.when(r == "", b)
        .when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), r)
        .when(F.startswith(r, F.lit("//")), F.concat(scheme, r))
        .when(F.startswith(r, F.lit("?")), F.concat(site, base_path, r))
        .when(F.startswith(r, F.lit("#")), F.concat(F.regexp_replace(b, "#.*$", ""), r))
        .otherwise(F.concat(site, _without_dots(merged), tail))
    )


def _without_dots(p: Column) -> Column:
    parts = F.split(p, "/")
    last = F.element_at(parts, -1)
    up = lambda acc: F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), lambda acc, x: F.when(x == ".", acc).when(x == "..", up(acc)).otherwise(F.concat(acc, F.array(x))))
    joined = F.array_join(walked, "/")
    return F.when(last.isin(".", "..") | (joined == ""), F.concat(joined, F.lit("/"))).otherwise(joined)
