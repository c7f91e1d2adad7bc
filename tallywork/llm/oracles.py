"""SQL for DuckDB of those queries that SQL can express, written apart from the operators."""

from __future__ import annotations

import math

ORACLES: dict[str, str] = {}

# Personal data. Of each kind: pattern, test of a span s, score and words nearby, least score.
_DIGITS = "regexp_replace(s.value, '[^0-9]', '', 'g')"
_ALONE = "NOT regexp_matches(s.before, '[0-9A-Za-z-]$') AND NOT regexp_matches(s.after, '^[0-9A-Za-z-]')"
_LUHN = (
    "list_sum(list_transform(range(1, length({d}) + 1), lambda i:"
    " CASE WHEN i % 2 = 0 THEN (2 * CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER)) % 10"
    " + (2 * CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER)) // 10"
    " ELSE CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER) END)) % 10 = 0"
).format(d=_DIGITS)
_CODE = "replace(s.value, ' ', '')"
_MOVED = f"(substr({_CODE}, 5) || substr({_CODE}, 1, 4))"
_MOD_97 = (
    f"list_reduce(list_prepend(0, list_transform(string_split({_MOVED}, ''), lambda c:"
    " CASE WHEN ascii(c) <= 57 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),"
    " lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"
)
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 80, "mail|contact|write to|@", 0),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(s.value, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 999))) <= 255", 60, "address|host|server|ip", 0),
    ("card", r"[0-9](?:[ -]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}", 75, "card|visa|credit|payment|pay", 0),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15", 60, "phone|call|tel|mobile|fax", 0),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", f"{_ALONE} AND length({_CODE}) BETWEEN 15 AND 34 AND {_MOD_97}", 75, "iban|account|bank|konto|compte|cuenta", 60),
    ("short_card", r"[0-9](?:[ -]?[0-9])+", f"{_ALONE} AND length({_DIGITS}) BETWEEN 13 AND 15 AND {_LUHN}", 45, "card|visa|credit|amex|payment", 60),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ALONE, 40, "ssn|social security", 60),
)


def _found(name: str, test: str, score: int, words: str, least: int) -> str:
    lengths = f"coalesce(list_sum(list_transform(g_{name}[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m_{name}[1:i - 1], lambda x: length(x))), 0)"
    span = (
        f"{{'kind': '{name}', 'start': CAST({lengths} AS BIGINT), 'end': CAST({lengths} + length(m_{name}[i]) AS BIGINT),"
        f" 'value': m_{name}[i], 'before': right(g_{name}[i], 40), 'after': left(g_{name}[i + 1], 40)}}"
    )
    spans = f"list_filter(list_transform(range(1, len(m_{name}) + 1), lambda i: {span}), lambda s: {test})"
    scored = f"least({score} + CASE WHEN regexp_matches(lower(s.before || ' ' || s.after), '{words}') THEN 25 ELSE 0 END, 100)"
    named = f"list_transform({spans}, lambda s: {{'kind': s.kind, 'start': s.start, 'end': s.end, 'score': {scored}}})"
    return f"list_filter({named}, lambda s: s.score >= {least}) AS s_{name}"


def _joined(spans: str, score: bool) -> str:
    last = " || ':' || s.score" if score else ""
    return f"coalesce(list_aggregate(list_transform({spans}, lambda s: s.kind || ':' || s.start || ':' || s.end{last}), 'string_agg', ','), '')"


_BASE = ["email", "ip", "card", "phone"]
ORACLES["op10_pii_spans"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
    SELECT doc_id,
           {", ".join(f"regexp_extract_all(text, '{p}') AS m_{k}, regexp_split_to_array(text, '{p}') AS g_{k}" for k, p, *_ in _KINDS)}
    FROM texts),
found AS (
    SELECT doc_id,
           {", ".join(_found(k, *rest) for k, _, *rest in _KINDS)}
    FROM cut),
spans AS (
    SELECT *, {" || ".join(f"s_{k}" for k in _BASE)} AS base,
           {" || ".join(f"s_{k}" for k, *_ in _KINDS)} AS every
    FROM found)
SELECT doc_id, {", ".join(f"CAST(len(s_{k}) AS BIGINT) AS n_{k}" for k in _BASE)},
       sha256({_joined("base", False)}) AS base_sha256,
       {_joined("every", False)} AS spans, {_joined("every", True)} AS scored
FROM spans"""


# Secrets. Base kinds: pattern, part of a match that has to be so long. Classes: runs, window, bits, what a span needs.
_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"(?:{_WORDS})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_SECRETS = (
    ("assign", _ASSIGN, f"length(regexp_extract(value, '{_ASSIGN}', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(value) >= 20"),
    ("hex", "[0-9a-f]{24,}", "true"),
)
_CLASSES = (
    ("high_hex", "[0-9A-Fa-f]{20,}", 20, 3.0, ("[0-9]", "[A-Fa-f]")),
    ("high_base64", "[A-Za-z0-9+/_=-]{24,}", 24, 3.9, ("[0-9]", "[A-Za-z]")),
    ("high_visible", "[!-~]{24,}", 24, 4.1, ("[0-9]", "[A-Z]", "[a-z]", "[^A-Za-z0-9+/_=-]")),
)
_ALLOWED = (
    "[a-z]+://[!-~]+",
    "[!-~]+@[A-Za-z0-9.-]+",
    "[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    "(?:md5|sha1|sha224|sha256|sha384|sha512)[-:=][0-9A-Za-z+/=]+",
    "[A-Za-z0-9+/]*EXAMPLE(?:KEY)?",
    "(?:0123456789|[aA][bB][cC][dD][eE][fF][gG][hH])[0-9A-Za-z+/_=-]*",
)


def _matches(pattern: str) -> str:
    """(doc_id, pos, value) of a pattern's matches in the texts, at counted from 0."""
    length = "coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0)"
    return f"""SELECT doc_id, CAST({length} AS BIGINT) AS pos, found[i] AS value FROM (
        SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found, regexp_split_to_array(text, '{pattern}') AS gaps FROM texts))"""


def _high(name: str, runs: str, window: int, bits: float, needs: tuple[str, ...]) -> str:
    """Spans of a class before anything is left out."""
    weight = "CAST(floor(c * log2(c) * 1048576 + 0.5) AS BIGINT)"
    full = int(window * math.log2(window) * 1048576 + 0.5)
    sums = f"list_sum(list_transform(map_values(list_aggregate(string_split(substr(value, p, {window}), ''), 'histogram')), lambda c: {weight}))"
    needed = " AND ".join(f"regexp_matches(substr(value, first, last - first + {window}), '{need}')" for need in needs)
    return f"""SELECT doc_id, '{name}' AS kind, pos + first - 1 AS start, pos + last + {window - 1} AS until, best * 1000 // {window << 20} AS entropy FROM (
        SELECT doc_id, pos, value, min(p) AS first, max(p) AS last, CAST(max(h) AS BIGINT) AS best FROM (
            SELECT *, sum(opens) OVER (PARTITION BY doc_id, pos ORDER BY p) AS part FROM (
                SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id, pos ORDER BY p) <= {window} THEN 0 ELSE 1 END AS opens FROM (
                    SELECT *, {full} - {sums} AS h FROM (SELECT *, unnest(range(1, length(value) - {window} + 2)) AS p FROM ({_matches(runs)})))
                WHERE h >= {int(bits * window * 1048576)}))
        GROUP BY doc_id, pos, value, part)
    WHERE {needed}"""


_LIES_IN = "EXISTS (SELECT 1 FROM {taken} t WHERE t.doc_id = s.doc_id AND t.start <= s.start AND t.until >= s.until)"
_SHOWN = "string_agg(kind || ':' || start || ':' || until{last}, ',' ORDER BY start, number)"
_KEPT_CLASSES = "".join(
    f"""
high_{i} AS ({_high(*given)}),
taken_{i + 1} AS (
    SELECT * FROM taken_{i} UNION ALL
    SELECT doc_id, {len(_SECRETS) + i} AS number, kind, start, until, entropy FROM high_{i} s
    WHERE NOT {_LIES_IN.format(taken=f"taken_{i}")} AND NOT {_LIES_IN.format(taken="allowed")}),"""
    for i, given in enumerate(_CLASSES)
)
ORACLES["op12_window_entropy"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
taken_0 AS (
    {" UNION ALL ".join(f"SELECT doc_id, {i} AS number, '{k}' AS kind, pos AS start, pos + length(value) AS until, CAST(NULL AS BIGINT) AS entropy FROM ({_matches(p)}) WHERE {test}" for i, (k, p, test) in enumerate(_SECRETS))}),
allowed AS ({" UNION ALL ".join(f"SELECT doc_id, pos AS start, pos + length(value) AS until FROM ({_matches(p)})" for p in _ALLOWED)}),{_KEPT_CLASSES}
base AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k, *_ in _SECRETS)}, {_SHOWN.format(last="")} AS listed
    FROM taken_0 GROUP BY doc_id),
every AS (
    SELECT doc_id, {_SHOWN.format(last="")} AS spans, {_SHOWN.format(last=" || coalesce(':' || entropy, '')")} AS scored
    FROM taken_{len(_CLASSES)} GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in _SECRETS)}, sha256(coalesce(listed, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scored, '') AS scored
FROM documents d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)"""


# Clustering: each round assigns all vectors to the nearest of the centroids and moves those that have any.
_FLOOR = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
_NEAREST = """
near_{r} AS MATERIALIZED (
    SELECT vec_id, v, q, arg_min(number, (distance, number)) AS number, min(distance) AS distance FROM (
        SELECT vec_id, v, q, number, CAST(list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS BIGINT) AS distance
        FROM kept, centroids_{r})
    GROUP BY vec_id, v, q),"""
_MOVED_TO = f"""
centroids_{{n}} AS MATERIALIZED (
    SELECT number, coalesce(m, c) AS c FROM centroids_{{r}} LEFT JOIN (
        SELECT number, list({_FLOOR} ORDER BY i) AS m FROM (
            SELECT number, i, sum(q[i]) AS s, count(*) AS n FROM near_{{r}}, range(1, 65) components(i) GROUP BY number, i)
        GROUP BY number) USING (number)),"""
_CLUSTER_ROUNDS = 5
ORACLES["op13_orchard"] = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS v, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids_0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY name, q) - 1 AS INTEGER) AS number, q AS c
    FROM (SELECT sha256('2:' || vec_id) AS name, q FROM kept ORDER BY name, q LIMIT 40)),{"".join(_NEAREST.format(r=r) + _MOVED_TO.format(r=r, n=r + 1) for r in range(_CLUSTER_ROUNDS))}{_NEAREST.format(r=_CLUSTER_ROUNDS)}
digests AS (
    SELECT number, sha256(list_aggregate(c, 'string_agg', ',')) AS centroid_sha256 FROM centroids_{_CLUSTER_ROUNDS})
SELECT vec_id, number AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near_{_CLUSTER_ROUNDS} JOIN digests USING (number)"""


# Conversations: every prefix of each spliced one is named by a digest; a subtree is what prefixes of one conversation share.
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(0, 8 * length({t}))), lambda a, i:"
    " CASE WHEN i % 8 = 0 THEN xor(xor(a, ascii({t}[i // 8 + 1])) >> 1, 3988292384 * (xor(a, ascii({t}[i // 8 + 1])) & 1))"
    " ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"
).format(t="CAST(conv_id AS VARCHAR)")
ORACLES["op11_prefix_trie"] = f"""
WITH own AS MATERIALIZED (
    SELECT conv_id, list({{'turn': length(role) || ':' || role || text, 'size': octet_length(encode(text))}} ORDER BY turn NULLS FIRST) AS turns
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id),
spliced AS MATERIALIZED (
    SELECT o.conv_id, coalesce(p.turns[1:h], []) || o.turns[h + 1:] AS turns
    FROM (SELECT *, {_CRC32} % 9 AS h FROM own) o LEFT JOIN own p ON p.conv_id = o.conv_id - o.conv_id % 5),
prefixes AS MATERIALIZED (
    SELECT conv_id, d AS depth, len(turns) AS turns, CASE WHEN d > 0 THEN turns[d].size ELSE 0 END AS size,
           sha256(CAST(list_transform(turns[1:d], lambda t: sha256(t.turn)) AS VARCHAR)) AS node,
           CASE WHEN d > 0 THEN sha256(CAST(list_transform(turns[1:d - 1], lambda t: sha256(t.turn)) AS VARCHAR)) END AS parent
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM spliced)),
nodes AS MATERIALIZED (
    SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * size AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY node, parent, depth, size),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
subtrees AS (
    SELECT up AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM (SELECT DISTINCT a.node AS up, b.node FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.depth <= b.depth)
    JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY up)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN subtrees s ON s.node = n.node"""
