"""SQL that gives the rows of the registered queries, where SQL can."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""

LINE_DEDUP = """
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), w AS (
  SELECT doc_id, unnest(range(0, greatest(len(lines) - 2, 0))) AS i, lines FROM d
), k AS (
  SELECT doc_id, i, lines[i + 1] AS a, lines[i + 2] AS b, lines[i + 3] AS c FROM w
  WHERE NOT (trim(lines[i + 1]) = '' AND trim(lines[i + 2]) = '' AND trim(lines[i + 3]) = '')
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS LAST, i) AS n FROM k
), gone AS (
  SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r WHERE n > 1
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS i FROM d
), kept AS (
  SELECT lines.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL), '') AS text
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.i = gone.i GROUP BY lines.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE kept.text END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

# The plain patterns and checks, in the order of the kinds.
_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (
        r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "list_max(list_transform(string_split(m, '.'), lambda x: x::HUGEINT)) <= 255",
    ),
    "card": (
        r"[0-9](?:[ -]?[0-9])+",
        "len(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''),"
        " lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT ELSE (x::INT * 2) % 10 + (x::INT * 2) // 10 END)) % 10 = 0",
    ),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "len(digits) BETWEEN 9 AND 15"),
    "iban": (
        "",
        "list_reduce(list_prepend(0, list_transform(string_split(substr(plain, 5) || substr(plain, 1, 4), ''),"
        " lambda x: CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END)),"
        " lambda a, v: CASE WHEN v > 9 THEN a * 100 + v ELSE a * 10 + v END % 97) = 1",
    ),
}


def _iban(lengths: dict[int, str]) -> str:
    """Account numbers by the length of their country, then any run of blocks of four."""
    fixed = [
        f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, names in lengths.items()
    ]
    return rf"(?:{'|'.join(fixed)})\b|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"


def pii(kinds: tuple, base: tuple, lengths: dict[int, str], made_up: str, keep_from: float) -> str:
    plain = {name: pattern for name, (pattern, _) in _PII.items()} | {"iban": _iban(lengths)}
    parts = [
        f"""
  SELECT doc_id, {place} AS place, '{kind.name}' AS kind, start, start + len(m) AS stop, score
  FROM (SELECT *, round({kind.score} + CASE WHEN regexp_matches(around, '{kind.words}') THEN 0.1 ELSE 0 END
                 - CASE WHEN regexp_matches(around, '{made_up}') THEN 0.4 ELSE 0 END, 2)::DOUBLE AS score FROM (
        SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits, replace(m, ' ', '') AS plain,
               sum(len(g)) OVER (PARTITION BY doc_id ORDER BY i)
               + coalesce(sum(len(m)) OVER (PARTITION BY doc_id ORDER BY i
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
               lower(right(g, 40) || ' ' || left(after, 40)) AS around
        FROM (SELECT doc_id, unnest(found) AS m, unnest(gaps[1:len(found)]) AS g, unnest(gaps[2:]) AS after,
                     unnest(range(0, len(found))) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{plain[kind.name]}') AS found,
                           string_split_regex(text, '{plain[kind.name]}') AS gaps
                    FROM documents WHERE regexp_matches(text, '{plain[kind.name]}')))))
  WHERE {_PII[kind.name][1]} AND {"true" if kind in base else f"score >= {keep_from}"}"""
        for place, kind in enumerate(kinds)
    ]
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in base)
    names = ", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in base)
    return f"""
WITH s AS ({" UNION ALL ".join(parts)}
), j AS (
  SELECT doc_id, {counts},
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, start) AS spans,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, start)
           FILTER (place < {len(base)}) AS base,
         string_agg(score::VARCHAR, ',' ORDER BY place, start) AS scores
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM documents d LEFT JOIN j ON d.doc_id = j.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), false)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _crc_row(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


def crc32(text: str) -> str:
    """SQL of the unsigned crc32 of the UTF-8 bytes of a text, byte by byte over a table."""
    digits = f"hex(encode({text}))"
    each = f"list_transform(range(0, len({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    table = [_crc_row(n) for n in range(256)]
    step = f"xor(c >> 8, {table}[xor(c & 255, b) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {each}), lambda c, b: {step}))"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The 64 letters from U+00C0 on, and as many ASCII signs, so that bytes are letters.
_LATIN = "".join(chr(0xC0 + i) for i in range(64))
_SIGNS = _UPPER + "0123456789" + "!#$%&()*+,-./:;<=>?@[]^_{|}~"

VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), hashed AS (
  SELECT run, times, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL)
), spelled AS (
  SELECT times, CASE WHEN h % 199 = 0 THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n, translate(word, '{_LATIN}', '{_SIGNS[:64]}') AS plain
  FROM spelled WHERE len(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM words a JOIN words b
    ON abs(len(a.plain) - len(b.plain)) <= 1 AND levenshtein(a.plain, b.plain) = 1
), best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY ALL
), judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other END AS form,
         CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word
), chain AS (
  SELECT word, word AS tip FROM judged
  UNION ALL SELECT chain.word, judged.form FROM chain JOIN judged ON chain.tip = judged.word WHERE judged.form IS NOT NULL
)
SELECT judged.word, form, tip AS root, n, n_near, form_n FROM judged
JOIN (SELECT chain.word, tip FROM chain JOIN judged ON tip = judged.word WHERE judged.form IS NULL) ends ON judged.word = ends.word
"""


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _climb(leaves: str, nodes: str, branch: str) -> str:
    """Recursive tables of the nodes over leaves (``<branch>, place, digest``), and of their runs of eight."""
    more = f"count(*) OVER (PARTITION BY {branch}) > 1"
    return f"""{nodes} AS (
  SELECT {branch}, 0 AS level, place, digest, {more} AS more FROM {leaves}
  UNION ALL
  SELECT {branch}, level + 1, parent, digest, {more} FROM (
    SELECT {branch}, level, place // 8 AS parent, sha256(string_agg(digest, '' ORDER BY place)) AS digest
    FROM {nodes} WHERE more GROUP BY {branch}, level, place // 8)
), {nodes}_runs AS (
  SELECT {branch}, level, place // 8 AS parent, list(digest ORDER BY place) AS run FROM {nodes} WHERE more GROUP BY ALL
)"""


def _fold(name: str, start: str, runs: str, same: str) -> str:
    """Recursive table that folds a digest and its siblings level by level over the runs of a tree."""
    own = "f.place % 8"
    return f"""{name} AS (
  SELECT * FROM ({start})
  UNION ALL
  SELECT row, f.lang, f.level + 1, f.place // 8, sha256(array_to_string(run[1:{own}] || [digest] || run[{own} + 2:], '')),
         beside || array_to_string(run[1:{own}] || run[{own} + 2:], '')
  FROM {name} f JOIN {runs} r ON r.level = f.level AND r.parent = f.place // 8{same}
)"""


_TAMPERED = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
         row_number() OVER () AS row
  FROM (SELECT doc_id, lang, {_leaf("text")} AS digest,
          CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(_TAMPERED)} ELSE {_leaf("text")} END AS forged FROM documents)
), {_climb("leaves", "nodes", "lang")}, subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, 0 AS whole FROM nodes WHERE NOT more
), {_climb("subroots", "upper", "whole")}, {
    _fold("low", "SELECT row, lang, 0 AS level, place, forged AS digest, '' AS beside FROM leaves",
          "nodes_runs", " AND r.lang IS NOT DISTINCT FROM f.lang")
}, tops AS (
  SELECT arg_max(low, level) AS f FROM low GROUP BY row
), {
    _fold("high", "SELECT f.row AS row, f.lang AS lang, 0 AS level, s.place, f.digest, f.beside FROM tops "
          "JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang", "upper_runs", "")
}, ends AS (SELECT arg_max(high, level) AS e FROM high GROUP BY row)
SELECT doc_id, leaves.digest AS leaf, subroots.digest AS subroot, root, sha256(e.beside) AS proof_sha256,
       e.digest AS folded_root, e.digest = root AS verified
FROM leaves JOIN ends ON e.row = leaves.row JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang,
     (SELECT digest AS root FROM upper WHERE NOT more)
"""
