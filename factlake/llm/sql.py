"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import divergence, exactdup, licenses, merkle, secrets


def _spans(kind: str, pattern: str, flags: str = "", extra: str = "") -> str:
    """A list of {start, kind, end} of one base kind; ``p`` are the pieces between matches."""
    n = secrets.KINDS.index(kind)
    keep = f"[s FOR s IN ({{0}}) IF {extra}]" if extra else "{0}"
    p, m = f"string_split_regex(t, '{flags}{pattern}')", f"regexp_extract_all(t, '{flags}{pattern}')"
    before = f"list_sum([length(x) FOR x IN ({p})[1:i]]) + coalesce(list_sum([length(x) FOR x IN ({m})[1:i - 1]]), 0)"
    row = f"{{{{'start': CAST({before} AS BIGINT), 'kind': {n}, 'end': CAST({before} + length(({m})[i]) AS BIGINT), 'i': i}}}}"
    return f"CASE WHEN regexp_matches(t, '{flags}{pattern}') THEN " + keep.format(f"[{row} FOR i IN range(1, len({m}) + 1)]".replace("{{", "{").replace("}}", "}")) + " ELSE [] END"


def secret_scan() -> str:
    q = lambda s: s.replace("'", "''")
    assign = q(secrets.ASSIGN.removeprefix("(?i)"))
    long = f"length(regexp_extract_all(t, '(?i){assign}', 2)[s.i]) >= {secrets.ASSIGN_LEAST}"
    table = "[" + ", ".join(f"CAST({v} AS BIGINT)" for v in secrets.TABLE) + "]"
    width, low = secrets.WIDTH, 2**40
    allowed = " OR ".join(f"regexp_matches(hits[s.i], '{q(p)}')" for p in secrets.ALLOWED) + f" OR NOT regexp_matches(hits[s.i], '{q(secrets.NO_WORDS)}')"
    limit = "CASE " + " ".join(f"WHEN regexp_matches(hits[s.i], '{q(p)}') THEN {secrets.FULL - secrets.least(bits)}" for _, p, bits in secrets.CLASSES) + " END"
    # the sum over a window, from scratch: for each distinct character the table's value of its count
    window = f"hits[s.i][k:k + {width - 1}]"
    entropy = f"list_min([list_sum([{table}[length({window}) - length(replace({window}, c, '')) + 1] FOR c IN list_distinct(string_split({window}, ''))]) FOR k IN range(1, length(hits[s.i]) - {width - 2})])"
    secret = f"(NOT ({allowed}) AND {entropy} <= {limit})"
    cand = q(secrets.CANDIDATE)
    met = """[b FOR b IN base IF b."start" < s."end" AND s."start" < b."end"]"""
    span = lambda a, b: f"{{'start': {a}, 'kind': s.kind, 'end': {b}}}"
    sides = "[" + span('s."start"', f'list_min([b."start" FOR b IN {met}])') + ", " + span(f'list_max([b."end" FOR b IN {met}])', 's."end"') + "]"
    parts = f"""CASE WHEN len({met}) = 0 THEN [{span('s."start"', 's."end"')}] ELSE [x FOR x IN {sides} IF x."end" - x."start" >= {secrets.PART}] END"""
    more = _spans("entropy", cand)
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    joined = lambda c: f"coalesce(array_to_string([{names}[s.kind + 1] || ':' || s.\"start\" || ':' || s.\"end\" FOR s IN list_sort({c})], ','), '')"
    strip = "[{'start': s.\"start\", 'kind': s.kind, 'end': s.\"end\"} FOR s IN %s]"
    count = lambda k: f"CAST(len([s FOR s IN base IF s.kind = {k}]) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT doc_id, t, {_spans('assign', assign, '(?i)', long)} AS a, {_spans('access', secrets.ACCESS)} AS k, {_spans('hex', secrets.HEX)} AS x,
    {more} AS m, regexp_extract_all(t, '{cand}') AS hits
  FROM d),
flat AS (
  SELECT doc_id, list_concat({strip % 'a'}, {strip % 'k'}, {strip % 'x'}) AS base, m, hits FROM found),
judged AS (
  SELECT doc_id, base, flatten([{parts} FOR s IN m IF {secret}]) AS more FROM flat)
SELECT doc_id, {count(0)} AS n_assign, {count(1)} AS n_access, {count(2)} AS n_hex,
  sha256({joined('base')}) AS base_sha256, {joined(f"list_concat(base, {strip % 'more'})")} AS spans,
  CAST(len(more) AS BIGINT) AS n_entropy
FROM judged"""


class Duck(licenses.Dialect):
    """The license scan's expressions as DuckDB writes them."""

    newline, group, flags, split, size, join = "chr(10)", "\\", "(?im)", "string_split", "len", "array_to_string"
    each, part, concat = "list_transform({0}, lambda {1}: {2})", "({0})[{1}:{2}]", "flatten([{0}])"

    def literal(self, text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def replaced(self, text: str, pattern: str, to: str) -> str:
        return f"regexp_replace({text}, {self.literal(pattern)}, {self.literal(to.replace('$', self.group))}, 'g')"

    def matches(self, text: str, pattern: str) -> str:
        return f"regexp_matches({text}, {self.literal(pattern)})"

    def chosen(self, items: str, name: str, condition: str) -> str:
        return f"list_filter({items}, lambda {name}: {condition})"

    def sha256(self, text: str) -> str:
        return f"sha256({text})"

    def places(self, pieces: str) -> str:
        return f"range(2, len({pieces}) + 1)"

    def none(self) -> str:
        return "CAST([] AS VARCHAR[])"


def license_scan() -> str:
    d = Duck()
    known = ", ".join(f"('{digest}', {d.literal(name)})" for digest, name in licenses.digests().items())
    unit = lambda grain, found: d.each.format(found, "x", f"{{'grain': '{grain}', 'digest': x}}")
    units = d.concat.format(", ".join((unit("document", "[sha256(c)]"), unit("line", d.found_lines("t")), unit("passage", d.found_passages("c")))))
    return f"""
WITH known(digest, license) AS (VALUES {known}),
d AS (SELECT doc_id, text AS t FROM documents WHERE {d.matches('text', licenses.hint())}),
w AS (SELECT doc_id, t, {d.canonical('t')} AS c FROM d),
u AS (SELECT doc_id, unnest({units}) AS x FROM w)
SELECT doc_id, license, x.grain AS grain, count(*) AS n_matches FROM u JOIN known ON known.digest = x.digest GROUP BY ALL"""


def exact_dedup() -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{exactdup.SPACE}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


#: Levels that the SQL has: sources of up to 16 ** 6 rows, up to 16 ** 3 sources.
ROW_LEVELS, SOURCE_LEVELS = 6, 3


def _levels(name: str, levels: int) -> str:
    """From ``name``0 (tree, i, n, h), i from 0, the levels above and each node's
    siblings: lone nodes go up as they are, others are hashed in runs of 16."""
    out = []
    for k in range(levels):
        run = f"PARTITION BY tree, i // {merkle.FAN} ORDER BY i ROWS BETWEEN"
        out.append(f"""{name}_s{k} AS (SELECT tree, i, n, h, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT tree, i // {merkle.FAN} AS i, CAST(ceil(any_value(n) / {merkle.FAN}) AS BIGINT) AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY ALL)""")
    return ",\n".join(out)


def _folds(name: str, levels: int, of: str, tree: str, i: str) -> str:
    """From ``of``, a step for each level: the proof and the folded digest so far."""
    out = []
    for k in range(levels):
        out.append(f"""{of}_{name}{k} AS (SELECT x.* EXCLUDE (proof, fold), proof || w.b || w.a AS proof, CASE WHEN w.n = 1 THEN fold ELSE sha256(w.b || fold || w.a) END AS fold
  FROM {of if k == 0 else f"{of}_{name}{k - 1}"} AS x JOIN {name}_s{k} AS w ON w.tree = x.{tree} AND w.i = x.{i} // {merkle.FAN**k})""")
    return ",\n".join(out)


def merkle_manifest() -> str:
    value = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in (*merkle.FIELDS[:-1], text)) + ")"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # unsigned crc32 of the decimal id, bit by bit: DuckDB has no crc32
    crc = "list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, x: list_reduce(list_prepend(xor(c, x), [CAST(0 AS BIGINT) FOR j IN range(8)]), lambda v, j: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"
    return f"""
WITH f AS (SELECT *, {leaf('text')} AS leaf, xor({crc}, 4294967295) % 5 = 0 AS bad FROM documents),
d AS (SELECT doc_id, leaf, CASE WHEN bad THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} ELSE leaf END AS fold, '' AS proof, CAST(0 AS BIGINT) AS none,
  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM f),
t0 AS (SELECT tree, i, n, leaf AS h FROM d),
{_levels("t", ROW_LEVELS)},
s0 AS (SELECT CAST(0 AS BIGINT) AS tree, tree AS i, count(*) OVER () AS n, h FROM t{ROW_LEVELS}),
{_levels("s", SOURCE_LEVELS)},
{_folds("t", ROW_LEVELS, "d", "tree", "i")},
e AS (SELECT * FROM d_t{ROW_LEVELS - 1}),
{_folds("s", SOURCE_LEVELS, "e", "none", "tree")}
SELECT x.doc_id, x.leaf, s0.h AS subroot, s{SOURCE_LEVELS}.h AS root, sha256(x.proof) AS proof_sha256, x.fold AS folded_root, x.fold = s{SOURCE_LEVELS}.h AS verified
FROM e_s{SOURCE_LEVELS - 1} AS x JOIN s0 ON s0.i = x.tree CROSS JOIN s{SOURCE_LEVELS}"""


def source_divergence() -> str:
    upper, big = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "CAST({} AS HUGEINT)"
    share = lambda c, total: f"1 + ({big.format('1000000000')} * ({c} + 1)) // {total}"
    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text, row_number() OVER () AS r FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.n AS all_n, coalesce(x.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL) x USING (lang, source, term)),
m AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source) AS total FROM c),
l AS (SELECT lang, sum(n) + count(*) AS total FROM k GROUP BY ALL),
p AS (SELECT lang, source, term, n, {share('n', 'm.total')} AS p, {share('all_n', 'l.total')} AS q FROM m JOIN l USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM both_parts QUALIFY part = 'pair' OR rank <= {divergence.RANKS}"""


ORACLE_SQL: dict[str, str] = {"op2_secret_scan": secret_scan(), "op4_license_scan": license_scan(), "op11_exact_dedup": exact_dedup(), "op12_merkle_manifest": merkle_manifest(), "op13_source_divergence": source_divergence()}
