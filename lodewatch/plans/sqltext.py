"""URL expressions as SQL text for the engine that checks results (inputs without percent escapes)."""

from __future__ import annotations


def host(c: str) -> str:
    return f"regexp_replace(regexp_replace(lower(regexp_extract({c}, '^[A-Za-z]+://([^/?#]*)', 1)), '^.*@', ''), ':[0-9]*$', '')"


def path(c: str) -> str:
    return f"regexp_extract({c}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"


def query(c: str) -> str:
    parts = f"string_split(regexp_extract({c}, '[?]([^#]*)', 1), '&')"
    return f"array_to_string(list_sort(list_filter({parts}, lambda p: regexp_matches(p, '^[^=]*=.+') and not regexp_matches(p, '(?i)^(utm_|fbclid|gclid|mc_|_hs|ref=)'))), '&')"


def _and_query(c: str) -> str:
    return f"case when {query(c)} <> '' then '?' || {query(c)} else '' end"


def key(c: str) -> str:
    return f"case when regexp_matches({c}, '^https?://') then lower(regexp_replace({host(c)}, '^www[.]', '') || regexp_replace({path(c)}, '/+$', '') || {_and_query(c)}) end"


def total(c: str) -> str:
    return f"coalesce({key(c)}, lower(trim({c})), '')"


def clean(c: str) -> str:
    return f"regexp_extract({c}, '^([a-z]+)://', 1) || '://' || {host(c)} || regexp_replace({path(c)}, '/+$', '') || {_and_query(c)}"


def domain(c: str) -> str:
    return f"regexp_extract({host(c)}, '([^.]*[.][^.]*)$', 1)"


def owned(entity: str, text: str, n: int) -> str:
    return f"coalesce(nullif(trim({entity}), ''), 'NA') || '-' || substr(sha1({text}), 1, {n})"


def is_pdf(c: str) -> str:
    return f"(lower({path(c)}) like '%.pdf' or lower({path(c)}) like '%/static-files/%' or lower({path(c)}) like '%/getattachment/%')"


def year(c: str) -> str:
    return f"coalesce(cast(list_max(list_filter(list_transform(regexp_extract_all({c}, '20[12][0-9]'), lambda y: cast(y as int)), lambda y: y <= 2027)) as varchar), '')"
