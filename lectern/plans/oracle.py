"""SQL counterparts of the derived corpora, composed into WITH clauses by name."""

from __future__ import annotations

from .. import canon
from . import corpus

WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def array(values) -> str:
    return "[" + ", ".join(_quote(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({array(values)})[(({index}) % {len(values)}) + 1]"


PARTS_SLUG = [p[0] for p in canon.PARTS]
PARTS_SHOWN = [p[1] for p in canon.PARTS]
STOP = ", ".join(_quote(w) for w in canon.STOPWORDS)


def collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{WS}+', ' ', 'g'))"


def tokens(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '[a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN ({STOP}))"


REF = (
    rf"^{WS}*([1-4]?{WS}?[A-Za-z](?:[A-Za-z.'']|{WS})*?){WS}+([0-9]+)"
    rf"(?::([0-9]+)(?:{WS}*[-\x{{2013}}]{WS}*([0-9]+))?)?{WS}*$"
)
OPEN_RANGE = rf"(?i),?{WS}*(seqq?|sqq)\.?{WS}*$"
INTERNAL = r"\b(I-II|II-II|III|Supplement|Suppl\.?|I)\s*:\s*([0-9]+)\s*:\s*([0-9]+)"


def normalized(source: str, raw: str = "raw") -> str:
    """SELECT that adds book, slug, chapter, v1, v2, ref, verse_keys, chapter_key."""
    return f"""
    SELECT p.*, CASE WHEN ok THEN book || ' ' || chapter || CASE WHEN v1 IS NULL THEN ''
             ELSE ':' || v1 || CASE WHEN v2 <> v1 THEN '-' || v2 ELSE '' END END END AS ref,
           CASE WHEN ok THEN slug || '/' || chapter END AS chapter_key,
           CASE WHEN ok AND v1 IS NULL THEN [slug || '/' || chapter]
                WHEN ok THEN list_transform(range(v1, v2 + 1), lambda x: slug || '/' || chapter || '/' || x) END AS verse_keys
    FROM (
      SELECT c.* EXCLUDE (g, m), a.name AS book, a.slug AS slug, a.slug IS NOT NULL AS ok,
             TRY_CAST(g.c AS INT) AS chapter, TRY_CAST(g.v AS INT) AS v1,
             greatest(TRY_CAST(g.v AS INT), coalesce(TRY_CAST(g.w AS INT), TRY_CAST(g.v AS INT))) AS v2
      FROM (SELECT *, regexp_extract(s, '{REF}', ['b', 'c', 'v', 'w']) AS g, regexp_matches(s, '{REF}') AS m
            FROM (SELECT *, regexp_replace({raw}, '{OPEN_RANGE}', '') AS s FROM {source})) c
      LEFT JOIN alias a ON c.m AND a.alias = regexp_replace(lower(g.b), '{WS}|[.]', '', 'g')
    ) p"""


def _opening() -> str:
    out = []
    for k, form in enumerate(corpus.OPENINGS):
        head, _, tail = form.partition("%d")
        said = f"{_quote(head)} || (i + 1) || {_quote(tail)}" if "%d" in form else _quote(form)
        out.append(f"WHEN (L + i) % 5 = {k} THEN {said}")
    return "CASE " + " ".join(out) + " END"


def _father(raw: str) -> str:
    aliases = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in canon.COMMENTATORS.items())
    word = (
        "CASE WHEN wi > 1 AND lower(w) IN ('of', 'the', 'of.') THEN lower(w) ELSE "
        "array_to_string(list_transform(string_split(w, '-'), lambda p: upper(p[1:1]) || lower(p[2:])), '-') END"
    )
    name = f"rtrim({collapse(raw)}, '.')"
    return (
        f"CASE lower({name}) {aliases} ELSE "
        f"array_to_string(list_transform(string_split({name}, ' '), lambda w, wi: {word}), ' ') END"
    )


_SLUGS = canon.BOOK_SLUGS


def _verses(number: str, verse: str, text: str, prefix: str, source: str, extra: str = "") -> str:
    return f"""
    SELECT '{prefix}.' || slug || '.' || chapter || '.' || verse AS id, name || ' ' || chapter || ':' || verse AS citation,
           name AS book, slug, chapter, verse, slug || '/' || chapter || '/' || verse AS verse_key, text {extra}
    FROM (SELECT {pick(_SLUGS, number)} AS slug, CAST({number} // {len(_SLUGS)} + 1 AS INT) AS chapter,
                 CAST({verse} AS INT) AS verse, {text} AS text FROM {source})
    JOIN book USING (slug)"""


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "alias": (
        "SELECT * FROM (VALUES "
        + ", ".join(f"({_quote(a)}, {_quote(s)}, {_quote(canon.NAME_OF[s])})" for a, s in canon.ALIASES.items())
        + ") t(alias, slug, name)",
        (),
    ),
    "book": (
        "SELECT * FROM (VALUES "
        + ", ".join(f"({_quote(s)}, {_quote(n)}, {c}, {i})" for i, (n, s, c, _) in enumerate(canon.BOOKS))
        + ") t(slug, name, chapters, pos)",
        (),
    ),
    "lin": (
        """SELECT doc_id, lang, source, n_chars, CAST(k - 1 AS INT) AS i, line, CAST(length(line) AS INT) AS L FROM (
           SELECT doc_id, lang, source, n_chars, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)""",
        (),
    ),
    "art": (
        f"""SELECT *, 'summa.st.' || slug || '.q' || q || '.a' || a AS id, 'ST ' || shown || ', q.' || q || ', a.' || a AS citation
        FROM (SELECT doc_id, lang, source, text, {pick(PARTS_SLUG, 'doc_id')} AS slug, {pick(PARTS_SHOWN, 'doc_id')} AS shown,
                     doc_id // 40 + 1 AS q, (doc_id // 5) % 8 + 1 AS a, string_split(text, chr(10))[1] AS title FROM documents)""",
        (),
    ),
    "seg": (f"SELECT doc_id, i, ({_opening()}) || line AS text FROM lin", ("lin",)),
    "cit": (
        f"""SELECT doc_id, i AS pos, CASE st
              WHEN 1 THEN nm || ' ' || c
              WHEN 2 THEN nm || ' ' || c || ':' || v || '-' || w
              WHEN 3 THEN nm || ' ' || c || ':' || v || ', seqq.'
              WHEN 4 THEN '  ' || nm || '   ' || c || ':' || v || ' '
              WHEN 5 THEN nm || ' ' || c || ':' || v || ' \u2013 ' || w
              WHEN 6 THEN 'Holy Writ'
              ELSE nm || ' ' || c || ':' || v END AS raw,
              CASE WHEN st = 7 THEN 'internal' ELSE 'scripture' END AS kind
        FROM (SELECT doc_id, i, (L + i) % 8 AS st, {pick(corpus.PRINTED, 'doc_id + 7 * i + L')} AS nm, L % 30 + 1 AS c,
                     (3 * L + i) % 25 + 1 AS v, (3 * L + i) % 25 + 1 + L % 4 - 1 AS w FROM lin)""",
        ("lin",),
    ),
    "norm": (normalized("(SELECT * FROM cit WHERE kind = 'scripture')"), ("cit", "alias")),
    "scr": ("SELECT n.*, art.id, art.citation, art.title FROM norm n JOIN art USING (doc_id)", ("norm", "art")),
    "vkey": ("SELECT doc_id, id, pos, ref, unnest(verse_keys) AS key FROM scr WHERE ok", ("scr",)),
    "idx": (
        """SELECT key, id, any_value(citation) AS citation, any_value(title) AS title, arg_min(ref, pos) AS ref FROM (
             SELECT id, citation, title, pos, ref, unnest(list_distinct(list_append(verse_keys, chapter_key))) AS key
             FROM scr WHERE ok) GROUP BY key, id""",
        ("scr",),
    ),
    "noted": (
        f"""SELECT doc_id, string_agg(' see ' || CASE WHEN i % 5 = 4 THEN 'XIII' WHEN i % 5 = 3 AND t % 5 = 4 THEN 'Supplement'
               ELSE {pick(PARTS_SHOWN, 't')} END || ' : ' || (t // 40 + 1) || ':0' || ((t // 5) % 8 + 1) || '.', '' ORDER BY i) AS note
        FROM (SELECT doc_id, i, doc_id // 2 + i * 13 AS t FROM lin) GROUP BY doc_id""",
        ("lin",),
    ),
    "inl": (
        f"""SELECT DISTINCT src, 'summa.st.' || CASE rtrim(upper(g.p), '.') WHEN 'I-II' THEN 'i-ii' WHEN 'II-II' THEN 'ii-ii'
              WHEN 'III' THEN 'iii' WHEN 'I' THEN 'i' ELSE 'suppl' END || '.q' || CAST(g.q AS BIGINT) || '.a' || CAST(g.a AS BIGINT) AS dst
        FROM (SELECT src, regexp_extract(m, '{INTERNAL}', ['p', 'q', 'a']) AS g FROM (
          SELECT art.id AS src, unnest(regexp_extract_all(text || note, '{INTERNAL}')) AS m FROM art JOIN noted USING (doc_id)))""",
        ("art", "noted"),
    ),
    "res": ("SELECT src, dst FROM inl WHERE src <> dst AND dst IN (SELECT id FROM art)", ("inl", "art")),
    "eng": (_verses("doc_id", "i + 1", collapse("line"), "drb", "lin"), ("lin", "book")),
    "latr": (
        _verses("conv_id", "turn + 1", "'<Chorus> ' || replace(text, ', ', ' / ')", "vg", "conversations"),
        ("book",),
    ),
    "lat": (
        "SELECT * EXCLUDE (text), text AS raw, "
        + collapse(r"translate(regexp_replace(text, '<[^>]*>', '', 'g'), '/\[]', '    ')")
        + " AS text FROM latr",
        ("latr",),
    ),
    "per": (
        f"""SELECT doc_id, 'chain.' || slug || '.' || ch || '.' || v1 || '.' || doc_id AS id, 'Golden Chain, ' || name || ' ' || ch || ':' || v1
             || CASE WHEN v2 <> v1 THEN '-' || v2 ELSE '' END AS citation, slug, name, ch, v1, v2, text,
             list_transform(range(v1, v2 + 1), lambda x: slug || '/' || ch || '/' || x) AS keys
        FROM (SELECT doc_id, text, {pick(canon.GOSPELS, 'doc_id')} AS slug, (doc_id // 4) % 28 + 1 AS ch, n_chars % 30 + 1 AS v1,
                     n_chars % 30 + 1 + doc_id % 3 AS v2 FROM documents) JOIN book USING (slug)""",
        ("book",),
    ),
    "frag": (
        f"SELECT doc_id, i, line AS text, {_father(pick(corpus.SPEAKERS, 'L + i'))} AS father FROM lin",
        ("lin",),
    ),
    "fsum": (
        """SELECT doc_id, string_agg(father, ', ' ORDER BY f) AS fathers,
                  string_agg(father, ', ' ORDER BY f) FILTER (WHERE father <> '') AS named,
                  count(*) FILTER (WHERE father <> '') AS n_named
           FROM (SELECT doc_id, father, min(i) AS f FROM frag GROUP BY 1, 2) GROUP BY 1""",
        ("frag",),
    ),
    "fidx": (
        """SELECT unnest(keys) AS key, id, citation, fathers AS father_summary FROM per JOIN fsum USING (doc_id)""",
        ("per", "fsum"),
    ),
    "fread": (
        """SELECT date, m, CASE m % 5 WHEN 0 THEN 'Mt ' || c || ', ' || v || '–' || (v + 3)
             WHEN 1 THEN 'Marc ' || c || ', ' || v || '.' || (v + 3) || '-' || (v + 5)
             WHEN 2 THEN 'Stabat Mater. Lc ' || c || ', ' || v || '-' || (v + 3)
             WHEN 3 THEN 'Jn ' || c || ', ' || v || '-' || (c + 1) || ', 2'
             ELSE 'Ps ' || c || ', ' || v END AS raw
           FROM (SELECT date, m, m % 10 + 1 AS c, m % 20 + 1 AS v FROM (
             SELECT CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS m FROM orders GROUP BY 1))""",
        (),
    ),
    "read": (
        """SELECT date, CASE g.b WHEN 'Mt' THEN 'Matthew' WHEN 'Mc' THEN 'Mark' WHEN 'Lc' THEN 'Luke' ELSE 'John' END || ' ' ||
             regexp_replace(replace(regexp_replace(g.r, '([0-9]+)\\s*,\\s*', '\\1:', 'g'), '.', ','), '\\s+', '', 'g') AS gospel
           FROM (SELECT date, regexp_extract(t, '\\b(Mt|Mc|Lc|Jn)\\s+([0-9].*)$', ['b', 'r']) AS g, regexp_matches(t, '\\b(Mt|Mc|Lc|Jn)\\s+([0-9].*)$') AS ok
             FROM (SELECT date, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
               trim(translate(raw, '\u00a0\u202f\u2009\u2007\u2011\u2012\u2013\u2014\u2212', '    -----')),
               '\\bMatthieu\\b', 'Mt', 'g'), '\\bMarc\\b', 'Mc', 'g'), '\\bLuc\\b', 'Lc', 'g'), '\\bJean\\b', 'Jn', 'g') AS t FROM fread))
           WHERE ok""",
        ("fread",),
    ),
    "refq": (
        f"""SELECT item_id AS request_id, CASE item_id % 3 WHEN 0 THEN nm || ' ' || c || ':' || v
              WHEN 1 THEN nm || ' ' || c || ':' || v || '-' || (v + 4) ELSE nm || ' ' || c END AS reference
        FROM (SELECT item_id, {pick(corpus.PRINTED, 'item_id')} AS nm, item_id % 9 + 1 AS c, item_id % 12 + 1 AS v FROM benchmark)""",
        (),
    ),
    "refn": (normalized("refq", "reference"), ("refq", "alias")),
    "citq": (
        f"""SELECT item_id AS request_id, CASE WHEN item_id % 7 = 6 THEN 'no such place' WHEN item_id % 7 = 5 THEN lower(t) ELSE t END AS citation
        FROM (SELECT item_id, 'ST ' || {pick(PARTS_SHOWN, 'item_id')} || ', q.' || (item_id // 8 + 1) || ', a.' || (item_id % 9 + 1) AS t FROM benchmark)""",
        (),
    ),
    "citr": (
        r"""SELECT q.request_id, q.citation AS asked, coalesce(art.id, CASE WHEN regexp_matches(q.citation, p) THEN
              'summa.st.' || rtrim(lower(regexp_extract(q.citation, p, 1)), '.') || '.q' || regexp_extract(q.citation, p, 2) || '.a' || regexp_extract(q.citation, p, 3) END) AS article_id
        FROM (SELECT *, '(?i)^\s*ST\s+(I-II|II-II|III|Suppl\.|I)\s*,\s*q\.([0-9]+)\s*,\s*a\.([0-9]+)' AS p FROM citq) q
        LEFT JOIN art ON art.citation = q.citation""",
        ("citq", "art"),
    ),
    "que": (
        "SELECT item_id * 2 AS query_id, text AS query FROM benchmark UNION ALL SELECT item_id * 2 + 1, reverse(text) FROM benchmark",
        (),
    ),
    "tok": (f"SELECT doc_id AS id, unnest({tokens('text')}) AS term FROM documents", ()),
    "tf": ("SELECT id, term, CAST(count(*) AS INT) AS f FROM tok GROUP BY 1, 2", ("tok",)),
    "df": ("SELECT term, count(*) AS df FROM tf GROUP BY 1", ("tf",)),
    "dl": (f"SELECT doc_id AS id, CAST(len({tokens('text')}) AS INT) AS dl FROM documents", ()),
    "st": ("SELECT count(*) AS n, avg(CAST(dl AS DOUBLE)) AS avgdl FROM dl", ("dl",)),
    "qt": (f"SELECT DISTINCT query_id, unnest({tokens('query')}) AS term FROM que", ("que",)),
    "cov": (
        """SELECT que.query_id, coalesce(c, 0.0) AS coverage FROM que LEFT JOIN (
             SELECT query_id, avg(CASE WHEN df.term IS NULL THEN 0.0 ELSE 1.0 END) AS c FROM qt LEFT JOIN df USING (term) GROUP BY 1) USING (query_id)""",
        ("que", "qt", "df"),
    ),
    "score": (
        """SELECT query_id, id, CAST(sum(CAST(round(ln(1 + (n - df + 0.5) / (df + 0.5)) * (f * 2.5) / (f + 1.5 * (0.25 + 0.75 * dl / avgdl)) * 1e12) AS BIGINT)) AS DOUBLE) / 1e12 AS score
           FROM qt JOIN cov USING (query_id) JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (id), st
           WHERE coverage >= 0.8 GROUP BY 1, 2""",
        ("qt", "cov", "tf", "df", "dl", "st"),
    ),
    "top5": (
        """SELECT query_id, rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank,
             max(score) OVER (PARTITION BY query_id) AS top FROM score) WHERE rank <= 5 AND top >= 0.5 AND score > 0""",
        ("score",),
    ),
}


def with_(*names: str) -> str:
    """WITH clause holding the named parts and what they build on, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][1]:
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + "\n"
