"""DuckDB SQL of op9_url_filter: rules, then aliases over canonical and refresh links,
relative and quoted targets and ``<base>`` included."""

from __future__ import annotations

_INSIDE = r"""\b(?:=\s*(?:"[^"]*"|''[^'']*'')|[^>])*>"""
_CANONICAL = r"""(?is)^<link\b.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b"""
_REFRESH = r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b"""
_ONE, _TWO = r"(?i)^(\.|%2e)$", r"(?i)^(\.|%2e){2}$"


def _attribute(tag: str, name: str) -> str:
    """An attribute's value, in quotes of either kind or bare."""
    pattern = r"""(?is)(?:^|[^\w-])NAME\s*=\s*(?:"([^"]*)"|''([^'']*)''|["'']?([^"''\s>]+))""".replace("NAME", name)
    return "(" + " || ".join(f"regexp_extract({tag}, '{pattern}', {k})" for k in (1, 2, 3)) + ")"


def _named(x: str) -> str:
    return r"nullif(replace(regexp_replace(X, '^\s+|\s+$', '', 'g'), '&amp;', '&'), '')".replace("X", x, 1)


def _resolved(name: str, source: str, base: str, target: str) -> str:
    """CTEs that end in ``name``: ``source`` with ``full_url``, ``target`` seen from ``base`` (RFC 3986, 5.2)."""
    text = r"""
NAME_a AS (SELECT *, regexp_extract(BASE, '(?s)^(.*?://[^/?#]*)', 1) AS site, regexp_extract(BASE, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(TARGET, '(?s)^([^?#]*)', 1) AS to_path FROM SOURCE),
NAME_b AS (SELECT *, substr(TARGET, length(to_path) + 1) AS rest, CASE WHEN starts_with(to_path, '/') THEN to_path
    ELSE coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || to_path END AS joined FROM NAME_a),
NAME_c AS (SELECT *, string_split(joined, '/')[2:] AS parts FROM NAME_b),
NAME_d AS (SELECT *, list_reduce(list_transform(parts, lambda x: [x]), lambda acc, x: CASE WHEN regexp_matches(x[1], 'ONE') THEN acc
    WHEN regexp_matches(x[1], 'TWO') THEN acc[:greatest(len(acc) - 1, 0)] ELSE list_concat(acc, x) END, []::VARCHAR[]) AS stack,
    regexp_matches(parts[-1], 'ONE') OR regexp_matches(parts[-1], 'TWO') AS folder FROM NAME_c),
NAME AS (SELECT * EXCLUDE (site, path, to_path, rest, joined, parts, stack, folder),
    CASE WHEN regexp_matches(TARGET, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN TARGET
         WHEN starts_with(TARGET, '//') THEN regexp_extract(BASE, '(?s)^(.*?:)//', 1) || TARGET
         WHEN to_path <> '' THEN site || CASE WHEN regexp_matches(joined, '(?i)/(\.|%2e)')
              THEN '/' || array_to_string(CASE WHEN folder THEN list_append(stack, '') ELSE stack END, '/') ELSE joined END || rest
         WHEN starts_with(rest, '?') THEN site || path || rest ELSE BASE END AS full_url FROM NAME_d)"""
    for word, value in (("NAME", name), ("SOURCE", source), ("BASE", base), ("TARGET", target), ("ONE", _ONE), ("TWO", _TWO)):
        text = text.replace(word, value)
    return text


_RULES = r"""
WITH RECURSIVE rules(rh, rp, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
urls AS (SELECT DISTINCT url FROM pages),
"""

_LINKS = (
    "tags AS (SELECT url, " + _named(_attribute(f"regexp_extract(html, '(?is)<base{_INSIDE}')", "href")) + " AS base,\n"
    f"    unnest(regexp_extract_all(html, '(?is)<(?:link|meta){_INSIDE}')) AS tag FROM pages),\n"
    "told AS (SELECT *, regexp_extract(" + _attribute("tag", "content") + r", '(?is)^[\s0-9.;,]*url\s*=\s*(.*)$', 1) AS refresh FROM tags),"
    "\nfound AS (SELECT url, coalesce(base, '') AS base, CASE WHEN regexp_matches(tag, '" + _CANONICAL + "') THEN " + _attribute("tag", "href")
    + "\n    WHEN regexp_matches(tag, '" + _REFRESH + "') THEN CASE WHEN left(refresh, 1) IN ('\"', '''')"
    " THEN split_part(substr(refresh, 2), left(refresh, 1), 1) ELSE refresh END END AS href FROM told),\n"
    "links AS (SELECT url, base, " + _named("href") + " AS target FROM found WHERE url IS NOT NULL AND " + _named("href") + " IS NOT NULL),"
    + _resolved("based", "links", "url", "base") + ",\nat_base AS (SELECT url, target, full_url AS seen_from FROM based),"
    + _resolved("reached", "at_base", "seen_from", "target") + ",\nfull_links AS (SELECT url, full_url AS target FROM reached),\n")

_VERDICTS = r"""
named AS (SELECT u, regexp_extract(u, '(?s)^([^#]*)', 1) AS bare FROM (SELECT url AS u FROM urls UNION SELECT target FROM full_links)
          WHERE contains(u, '://')),
nodes AS (SELECT u, translate(regexp_extract(bare, '(?s)^(.*?://[^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                    || regexp_extract(bare, '(?s)^.*?://[^/?]*(.*)$', 1) AS node FROM named),
edges AS (SELECT a.node AS x, b.node AS y FROM full_links l JOIN nodes a ON a.u = l.url JOIN nodes b ON b.u = l.target),
both_ways AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
parsed AS (SELECT u, coalesce(translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
           FROM (SELECT url AS u FROM urls UNION SELECT target FROM full_links)),
fitting AS (SELECT u, host, path, rh || rp AS rule, action,
                   row_number() OVER (PARTITION BY u ORDER BY length(rh || rp) DESC NULLS LAST) AS k
            FROM parsed LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
judged AS (SELECT * FROM fitting WHERE k = 1),
blocked AS (SELECT n.node FROM judged j JOIN nodes n ON n.u = j.u WHERE j.action = 'block'
            UNION SELECT b.y FROM blocked JOIN both_ways b ON b.x = blocked.node)
SELECT p.page_id, j.host, j.path, j.rule,
       coalesce(j.action, CASE WHEN n.node IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p JOIN judged j ON j.u IS NOT DISTINCT FROM p.url LEFT JOIN nodes n ON n.u = p.url
"""

OP9_SQL = _RULES + _LINKS + _VERDICTS
