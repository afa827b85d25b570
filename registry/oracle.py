"""SQL counterparts of the registered queries, written as brute force over whole tables."""

from __future__ import annotations

from termloom.functions.text import STOPWORDS

_BLANK = r"[ \t\n\x0B\f\r]"
_STOP = ", ".join(f"'{word}'" for word in STOPWORDS)


def _words(text: str) -> str:
    folded = f"replace(strip_accents(lower({text})), 'ß', 'ss')"
    letters = rf"regexp_replace({folded}, '[^a-z \t\n\x0B\f\r]', '', 'g')"
    return f"list_filter(regexp_split_to_array({letters}, '{_BLANK}+'), lambda w: w <> '')"


def _tokens(text: str) -> str:
    return f"list_filter({_words(text)}, lambda w: w NOT IN ({_STOP}))"


def _index(source: str = "documents", key: str = "doc_id") -> str:
    """Common tables of an index over ``source``."""
    return f"""
    doc AS (
        SELECT *, array_to_string(tokens, ' ') AS joined FROM (
            SELECT {key} AS doc_id, {_tokens('text')} AS tokens FROM {source})
        WHERE len(tokens) > 0),
    post AS (
        SELECT doc_id, term, count(*)::INTEGER AS tf,
               string_agg(pos::VARCHAR, ',' ORDER BY pos) AS positions
        FROM (SELECT doc_id, unnest(tokens) AS term, unnest(range(len(tokens))) AS pos FROM doc)
        GROUP BY doc_id, term),
    dict AS (
        SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term),
    stats AS (
        SELECT doc_id, sum(tf)::INTEGER AS total_terms,
               sqrt(sum(tf * tf)::DOUBLE) / sum(tf) AS doc_magnitude
        FROM post GROUP BY doc_id)"""


# (query_id, disjunct_id, leaf_id, kind, value, negated), worked out by hand.
_SAMPLE_LEAVES = [
    (1, 0, 1, "term", "the", False),
    (2, 0, 1, "term", "disgusting", False),
    (3, 0, 1, "term", "the", False), (3, 0, 2, "term", "of", False),
    (4, 0, 1, "term", "tion", False), (4, 0, 2, "term", "the", True),
    (5, 0, 1, "term", "lich", False), (5, 1, 2, "term", "ouen", False),
    (5, 1, 3, "term", "elle", False),
    (6, 0, 1, "term", "evi", False), (6, 1, 2, "term", "tion", False),
    (7, 0, 1, "phrase", "of the", False),
    (8, 0, 1, "pattern", "gust", False), (8, 1, 2, "pattern", "o_thon", False),
    (9, 0, 1, "term", "the", True),
    (10, 0, 1, "term", "casa", False), (10, 1, 2, "term", None, False),
    (10, 2, 3, "term", None, False), (10, 3, 4, "term", "tion", False),
    (10, 4, 5, "term", "tion", False),
    (11, 0, 1, "term", "the", False), (11, 0, 2, "term", None, False),
    (13, 0, 1, "phrase", "and the", False), (13, 0, 2, "term", "tion", False),
    (13, 0, 3, "pattern", "onth", True),
    (14, 0, 1, "term", "the", True), (14, 0, 2, "term", "ou", True),
    (14, 1, 3, "term", "disgusting", False),
    (15, 0, 1, "pattern", "tion", False), (15, 0, 2, "term", "eine", False),
    (16, 0, 1, "term", "sch", False), (16, 1, 2, "term", "ung", False),
    (16, 1, 3, "term", None, True),
]


def _terms(query_id: int, *groups: list[str]) -> list[tuple]:
    """Term leaves of one query; each group is a disjunct, ``-`` marks a negated term."""
    leaves, number = [], 0
    for disjunct, group in enumerate(groups):
        for word in group:
            number += 1
            leaves.append(
                (query_id, disjunct, number, "term", word.lstrip("-"), word.startswith("-"))
            )
    return leaves


_BOOLEAN_LEAVES = {
    "bool_and": _terms(1, ["the", "tion"]) + _terms(2, ["elle", "ouen", "ou"])
    + _terms(3, ["the", "absent"]),
    "bool_or": _terms(1, ["the"], ["tion"]) + _terms(2, ["elle"], ["lich"], ["ung"])
    + _terms(3, ["absent"], ["disgusting"]),
    "bool_and_not": _terms(1, ["the", "-tion"]) + _terms(2, ["tion", "-the", "-ou"]),
    "bool_not_only": _terms(1, ["-the"]) + _terms(2, ["-the", "-ou"]) + _terms(3, ["-absent"]),
    "bool_precedence": _terms(1, ["lich"], ["the", "-tion"]) + _terms(2, ["-the"], ["elle", "ou"]),
}


def _leaves(rows: list[tuple]) -> str:
    def literal(value):
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value).upper()

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"""
    leaves AS (
        SELECT query_id::BIGINT AS query_id, disjunct_id::INTEGER AS disjunct_id,
               leaf_id::INTEGER AS leaf_id, kind, value::VARCHAR AS value, negated
        FROM (VALUES {values}) AS v(query_id, disjunct_id, leaf_id, kind, value, negated))"""


def _single(kind: str, values: list) -> list[tuple]:
    return [(i, 0, 1, kind, value, False) for i, value in enumerate(values, 1)]


# Every leaf is tried on every document.
_HITS = """
    hits AS (
        SELECT l.query_id, l.disjunct_id, l.leaf_id, l.negated, d.doc_id,
               coalesce(CASE l.kind
                   WHEN 'term' THEN list_contains(d.tokens, l.value)
                   WHEN 'pattern' THEN
                       len(list_filter(d.tokens, lambda t: t LIKE '%' || l.value || '%')) > 0
                   ELSE l.value <> '' AND contains(' ' || d.joined || ' ', ' ' || l.value || ' ')
               END, FALSE) AS hit
        FROM leaves l CROSS JOIN doc d)"""

# Term leaves only, found by a join; for logs with very many leaves.
_TERM_HITS = """
    hits AS (
        SELECT l.query_id, l.disjunct_id, l.leaf_id, l.negated, d.doc_id,
               p.doc_id IS NOT NULL AS hit
        FROM leaves l CROSS JOIN doc d
        LEFT JOIN post p ON p.doc_id = d.doc_id AND p.term = l.value)"""

_MATCHES = """
    matches AS (
        SELECT DISTINCT query_id, doc_id FROM (
            SELECT query_id, disjunct_id, doc_id, bool_and(hit <> negated) AS holds
            FROM hits GROUP BY query_id, disjunct_id, doc_id)
        WHERE holds)"""

_QUERY_TERMS = """
    query_terms AS (
        SELECT query_id, value AS term FROM leaves WHERE kind <> 'phrase' AND value IS NOT NULL
        UNION ALL
        SELECT query_id, unnest(string_split(value, ' ')) FROM leaves
        WHERE kind = 'phrase' AND value <> '')"""

_WEIGHTS = """
    weights AS (
        SELECT query_id, term, idf,
               n / length * idf AS query_weight,
               sqrt(sum(pow(n / length * idf, 2)) OVER (PARTITION BY query_id)) AS query_magnitude
        FROM (SELECT query_id, term, n, length, ln(n_docs / coalesce(df, 1)) AS idf
              FROM (SELECT query_id, term, count(*) AS n,
                           sum(count(*)) OVER (PARTITION BY query_id) AS length
                    FROM query_terms GROUP BY query_id, term)
              LEFT JOIN dict USING (term)
              CROSS JOIN (SELECT count(*) AS n_docs FROM stats)))"""

_SCORED = """
    scored AS (
        SELECT query_id, doc_id, coalesce(score, 0) AS score,
               CASE WHEN doc_magnitude > 0 AND query_magnitude > 0
                    THEN dot / (doc_magnitude * query_magnitude) ELSE 0 END AS cosine_sim
        FROM matches
        SEMI JOIN query_terms USING (query_id)
        JOIN stats USING (doc_id)
        LEFT JOIN (
            SELECT query_id, doc_id, sum(tf / total_terms * idf) AS score,
                   sum(tf / total_terms * idf * query_weight) AS dot,
                   max(query_magnitude) AS query_magnitude
            FROM weights JOIN post USING (term) JOIN stats USING (doc_id)
            GROUP BY query_id, doc_id) USING (query_id, doc_id))"""

_RANKED = """
    ranked AS (
        SELECT query_id,
               row_number() OVER (PARTITION BY query_id
                                  ORDER BY round(score, 10) DESC, doc_id)::INTEGER AS rank,
               doc_id, doc_id::VARCHAR AS filename, NULL::VARCHAR AS filepath,
               left(text, 250) AS snippet,
               round(score, 8) AS score, round(cosine_sim, 8) AS cosine_sim
        FROM scored JOIN documents USING (doc_id))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _ranked(leaves: str, select: str, hits: str = _HITS) -> str:
    scored = (_QUERY_TERMS, _WEIGHTS, _SCORED, _RANKED)
    return _with(_index(), leaves, hits, _MATCHES, *scored) + select


def _log_leaves(log: str, split_words: bool = False) -> str:
    """Leaves of a log without function calls, given as SQL with query_id and q."""
    q = "lower(q)"
    if split_words:
        q = rf"regexp_replace({q}, '(and|or|not)', ' \1 ', 'g')"
    return rf"""
    roles AS (
        SELECT query_id, parts,
               list_transform(parts, lambda p: CASE p WHEN 'and' THEN 'a' WHEN 'or' THEN 'o'
                                               WHEN 'not' THEN 'n' ELSE 'x' END) AS role
        FROM (SELECT query_id, regexp_extract_all({q}, '[^ \t\n\x0B\f\r]+') AS parts
              FROM ({log}) WHERE trim(q) <> '')),
    shaped AS (
        SELECT *, regexp_matches(array_to_string(role, ''),
                                 '(^|[aon])a|a([ao]|$)|n([^x]|$)|[xn]n') AS malformed
        FROM roles),
    leaves AS (
        SELECT query_id,
               (len(list_filter(role[1:place], lambda r: r = 'o'))
                + len(list_filter(range(2, place + 1),
                                  lambda i: (role[i] = 'x' AND role[i - 1] = 'x'))))::INTEGER
                   AS disjunct_id,
               len(list_filter(role[1:place], lambda r: r = 'x'))::INTEGER AS leaf_id,
               'term' AS kind, {_tokens('part')}[1] AS value,
               place > 1 AND role[place - 1] = 'n' AS negated
        FROM (SELECT *, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS place
              FROM shaped WHERE NOT malformed)
        WHERE role[place] = 'x')"""


_CONVERSATIONS = "SELECT (conv_id + turn) * (conv_id + turn + 1) // 2 + turn AS query_id, text AS q FROM conversations"
_PASSAGES = "SELECT item_id AS query_id, text AS q FROM benchmark"
_PHRASES = f"""
    SELECT item_id AS query_id, 0 AS disjunct_id, 1 AS leaf_id, 'phrase' AS kind,
           array_to_string({_tokens('text')}, ' ') AS value, FALSE AS negated
    FROM benchmark"""

_ARRIVALS = """
        SELECT conv_id::VARCHAR AS filename, turn AS seq, text FROM conversations
        UNION ALL
        SELECT 'Item-' || item_id, 0, text FROM benchmark"""
_MIXED_ARRIVALS = """
        SELECT 'Árbol-' || doc_id || '.TXT' AS filename, 0::BIGINT AS seq, text FROM documents
        UNION ALL
        SELECT 'arbol-' || doc_id || '.txt', 1,
               CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '12 34' WHEN 2 THEN 'de la' ELSE 'otra ' || text END
        FROM documents
        UNION ALL
        SELECT doc_id::VARCHAR, 2, CASE doc_id % 2 WHEN 0 THEN '...' ELSE text || ' nuevo' END FROM documents"""


def _final(arrivals: str) -> str:
    """The corpus after a batch: the last valid text of every key."""
    return f"""
    arrivals AS (
        SELECT *, strip_accents(lower(filename)) AS doc_key FROM ({arrivals})),
    valid AS (SELECT * FROM arrivals WHERE len({_tokens('text')}) > 0),
    newest AS (
        SELECT * FROM valid
        QUALIFY row_number() OVER (PARTITION BY doc_key ORDER BY seq DESC) = 1),
    final AS (
        SELECT filename, doc_key, text FROM newest
        UNION ALL
        SELECT doc_id::VARCHAR, doc_id::VARCHAR, text FROM documents
        WHERE doc_id::VARCHAR NOT IN (SELECT doc_key FROM newest))"""


_FINAL, _MIXED_FINAL = _final(_ARRIVALS), _final(_MIXED_ARRIVALS)
_FINAL_INDEX = _index("final", "filename")


def _report(final: str) -> str:
    return _with(final) + f"""
            SELECT doc_key, seq, CASE
                WHEN text IS NULL THEN 'failed'
                WHEN len({_tokens('text')}) = 0 THEN 'skipped'
                WHEN doc_key IN (SELECT doc_id::VARCHAR FROM documents WHERE len({_tokens('text')}) > 0)
                     OR seq > (SELECT min(seq) FROM valid v WHERE v.doc_key = arrivals.doc_key)
                THEN 're-indexed' ELSE 'indexed' END AS status
            FROM arrivals"""


# Two words of every conversation turn, and the leaves of the query that is made of them.
_MIXED_WORDS = """
    words AS (
        SELECT query_id, coalesce(w[1], 'pan') AS w1, coalesce(w[2], 'vino') AS w2
        FROM (SELECT (conv_id + turn) * (conv_id + turn + 1) // 2 + turn AS query_id,
                     list_filter(string_split(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' '),
                                 lambda x: lower(x) NOT IN ('', 'and', 'or', 'not')) AS w
              FROM conversations))"""
_MIXED_LEAVES = f"""
    leaves AS (
        SELECT query_id, 0 AS disjunct_id, 1 AS leaf_id, 'term' AS kind, {_tokens('w1')}[1] AS value, TRUE AS negated
        FROM words WHERE query_id % 6 = 0
        UNION ALL
        SELECT query_id, 0, 2, 'term', {_tokens('w2')}[1], FALSE FROM words WHERE query_id % 6 = 0
        UNION ALL
        SELECT query_id, 0, 1, 'phrase', array_to_string({_tokens("w1 || ' ' || w2")}, ' '), FALSE
        FROM words WHERE query_id % 6 = 1
        UNION ALL
        SELECT query_id, 0, 1, 'pattern', lower(left(w1, 4)), FALSE FROM words WHERE query_id % 6 = 2
        UNION ALL
        SELECT query_id, unnest([0, 1]), unnest([1, 2]), 'term', NULL, FALSE FROM words WHERE query_id % 6 = 4)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "normalize_tokens":
            f"SELECT doc_id, array_to_string({_tokens('text')}, ' ') AS tokens FROM documents",
        "stopword_filtered_counts":
            f"SELECT doc_id, len({_words('text')})::INTEGER AS n_words, "
            f"len({_tokens('text')})::INTEGER AS n_tokens FROM documents",
        "snippets": "SELECT doc_id, left(text, 250) AS snippet FROM documents",
        "postings": _with(_index()) + "SELECT doc_id, term, tf, positions FROM post",
        "term_dictionary": _with(_index()) + "SELECT term, df, cf FROM dict",
        "document_stats": _with(_index())
        + "SELECT doc_id, doc_id::VARCHAR AS filename, doc_id::VARCHAR AS doc_key, total_terms, "
          "round(doc_magnitude, 8) AS doc_magnitude FROM stats",
        "corpus_size": _with(_index()) + "SELECT count(*) AS n_docs FROM doc",
        "document_ids": _with(_index()) + "SELECT doc_id FROM doc",
        "phrase_batch_benchmark": _with(_index(), f"leaves AS ({_PHRASES})", _HITS)
        + "SELECT query_id, doc_id FROM hits WHERE hit",
        "query_weights": _with(_index(), _log_leaves(_PASSAGES), _QUERY_TERMS, _WEIGHTS)
        + "SELECT query_id, term, round(idf, 8) AS idf, round(query_weight, 8) AS query_weight, "
          "round(query_magnitude, 8) AS query_magnitude FROM weights",
        "query_log_leaves": _with(_log_leaves(_CONVERSATIONS)) + "SELECT * FROM leaves",
        "query_log_split_words":
            _with(_log_leaves(_CONVERSATIONS, split_words=True)) + "SELECT * FROM leaves",
        "query_log_scoring_terms": _with(
            _log_leaves(_CONVERSATIONS).replace("leaves AS (", "turns AS ("),
            f"leaves AS (SELECT * FROM turns UNION ALL ({_PHRASES}))",
            _QUERY_TERMS,
        ) + "SELECT query_id, term FROM query_terms",
        "query_log_status": _with(_log_leaves(_CONVERSATIONS), _QUERY_TERMS) + """
            SELECT query_id, CASE
                WHEN malformed IS NULL THEN 'blank'
                WHEN malformed THEN 'malformed'
                WHEN query_id NOT IN (SELECT query_id FROM query_terms) THEN 'no_scoring_terms'
                ELSE 'ok' END AS status
            FROM (SELECT (conv_id + turn) * (conv_id + turn + 1) // 2 + turn AS query_id FROM conversations)
            LEFT JOIN shaped USING (query_id)""",
        "batch_ranked_search":
            _ranked(_log_leaves(_PASSAGES), "SELECT * FROM ranked", hits=_TERM_HITS),
        "upsert_index": _with(_FINAL, _FINAL_INDEX) + """
            SELECT filename, doc_key, left(text, 250) AS snippet, total_terms,
                   round(doc_magnitude, 8) AS doc_magnitude
            FROM stats JOIN final ON filename = doc_id""",
        "upsert_postings": _with(_FINAL, _FINAL_INDEX)
        + "SELECT lower(doc_id) AS doc_key, term, tf, positions FROM post",
        "upsert_term_counters": _with(_FINAL, _FINAL_INDEX) + "SELECT term, df, cf FROM dict",
        "orphan_purge": _with(_FINAL, _FINAL_INDEX) + f"""
            SELECT DISTINCT term FROM (SELECT unnest({_tokens('text')}) AS term FROM documents)
            WHERE term NOT IN (SELECT term FROM dict)""",
        "ingest_report": _report(_FINAL),
        "mixed_batch_report": _report(_MIXED_FINAL),
        "mixed_batch_terms": _with(_MIXED_FINAL, _FINAL_INDEX) + "SELECT term, df, cf FROM dict",
        "mixed_log_status": _with(_MIXED_WORDS, _MIXED_LEAVES, _QUERY_TERMS) + """
            SELECT query_id, CASE query_id % 6
                WHEN 3 THEN 'blank' WHEN 5 THEN 'malformed' ELSE CASE
                WHEN query_id NOT IN (SELECT query_id FROM query_terms) THEN 'no_scoring_terms'
                ELSE 'ok' END END AS status
            FROM words""",
        "mixed_log_leaves": _with(_MIXED_WORDS, _MIXED_LEAVES) + "SELECT * FROM leaves",
        "mixed_log_search": _with(_index(), _MIXED_WORDS, _MIXED_LEAVES, _HITS, _MATCHES)
        + "SELECT * FROM matches",
    }
    sql["mixed_batch_index"] = sql["upsert_index"].replace(_FINAL, _MIXED_FINAL)
    sql["stored_postings"] = sql["postings"]
    sql["stored_terms"] = sql["term_dictionary"]
    sql["term_lookup"] = _with(_index()) + "SELECT doc_id FROM post WHERE term = 'the'"
    # The last pattern is typed with a backslash, which stands for the letter after it.
    sql["pattern_terms"] = _with(_index()) + r"""
        SELECT value, term FROM dict, (VALUES
            ('gust', 'gust'), ('o_thon', 'o_thon'), ('li%ch', 'li%ch'), ('q', 'q'),
            ('c\uen', 'cuen')) AS p(value, pattern)
        WHERE term LIKE '%' || pattern || '%'"""
    sql["phrase_skip_repeated"] = _with(
        _index(),
        f"""leaves AS (
            SELECT * FROM ({_PHRASES})
            WHERE len(list_distinct(string_split(value, ' '))) = len(string_split(value, ' ')))""",
        _HITS,
    ) + "SELECT query_id, doc_id FROM hits WHERE hit"

    hits = "SELECT query_id, leaf_id, doc_id FROM hits WHERE hit"
    for name, kind, values in (
        ("term_match", "term", ["the", "disgusting", "evi", "absent"]),
        ("pattern_match", "pattern", ["onth", "gust", "lich"]),
        ("pattern_wildcards", "pattern", ["o_th", "dis%ing", "_" * 20, "", "évi"]),
        ("phrase_match", "phrase", ["of the", "in the", "ou", "the the", ""]),
    ):
        leaves = _leaves(_single(kind, values))
        sql[name] = _with(_index(), leaves, _HITS) + hits
    sql["term_match"] = _with(
        _index(),
        _leaves(_single("term", ["the", "disgusting", "evi", "absent"])
                + [(3, 1, 2, "term", "ofonrereer", False)]),
        _HITS,
    ) + hits
    sample = _leaves(_SAMPLE_LEAVES)
    sql["leaf_hits"] = _with(_index(), sample, _HITS) + hits
    for name, rows in _BOOLEAN_LEAVES.items():
        sql[name] = _with(_index(), _leaves(rows), _HITS, _MATCHES) + "SELECT * FROM matches"
    sql["leaf_counts"] = _with(_index(), sample, _HITS) + """
        SELECT query_id, leaf_id, count(*) FILTER (WHERE hit) AS n_docs
        FROM hits GROUP BY query_id, leaf_id"""
    sql["match_counts"] = _with(_index(), sample, _HITS, _MATCHES) + """
        SELECT query_id, count(doc_id) AS n_docs
        FROM (SELECT DISTINCT query_id FROM leaves) LEFT JOIN matches USING (query_id)
        GROUP BY query_id"""

    single = _leaves(_terms(1, ["disgusting"]))
    several = _leaves(_terms(1, ["the"], ["tion"], ["lich"], ["ouen"]))
    repeated = _leaves(_terms(1, ["the"], ["the"], ["tion"], ["lich"], ["ouen"], ["absent"]))
    sql["tfidf_single_term"] = _ranked(single, "SELECT doc_id, score FROM ranked")
    sql["tfidf_multi_term"] = _ranked(several, "SELECT doc_id, score FROM ranked")
    sql["cosine_similarity"] = _ranked(repeated, "SELECT doc_id, cosine_sim FROM ranked")
    sql["ranked_search"] = _ranked(sample, "SELECT * FROM ranked")
    sql["top_k_per_query"] = _ranked(sample, "SELECT * FROM ranked WHERE rank <= 10")
    unscored = _leaves(_single("pattern", ["onth"]) + [(2, 0, 1, "term", "the", True)])
    sql["zero_score_kept"] = _ranked(unscored, "SELECT * FROM ranked")
    return sql
