"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

import re

from docquarry.functions.fixed import CHARSET_RE, TOKEN_RE
from docquarry.plans.workspace import LABEL_BLOCK, LEXICON_COUNT, STOPWORD_SHARE
from docquarry.registry.queries import CUTOFF, LOOKUP_ID, SAMPLE_ROWS


def _clean(text: str) -> str:
    return f"replace(lower(nfc_normalize(coalesce({text}, ''))), chr(65533), ' ')"


def _words(text: str) -> str:
    return f"regexp_extract_all({_clean(text)}, '{TOKEN_RE}')"


KEPT = f"length(token) >= 2 AND regexp_matches(token, '{CHARSET_RE}')"

# Building blocks: name -> (needed blocks, definition).
BLOCKS: dict[str, tuple[list[str], str]] = {
    "corpus": ([], "SELECT doc_id, min(text) AS text FROM documents GROUP BY doc_id"),
    "n": (["corpus"], "SELECT count(*) AS n FROM corpus"),
    "wordlists": (["corpus"], f"SELECT doc_id, {_words('text')} AS l FROM corpus"),
    "words": (
        ["wordlists"],
        "SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM wordlists",
    ),
    "tok": (
        ["words"],
        f"""SELECT doc_id, token,
            row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos
            FROM words WHERE {KEPT}""",
    ),
    "post": (
        ["tok"],
        "SELECT doc_id, token AS term, count(*) AS tf FROM tok GROUP BY doc_id, token",
    ),
    "terms": (
        ["post", "n"],
        """SELECT term, df, log10((1 + n) / (1 + df)) + 1 AS idf,
            ln((n - df + 0.5) / (df + 0.5) + 1) AS bm25_idf
            FROM (SELECT term, count(*) AS df FROM post GROUP BY term), n""",
    ),
    "lens": (["post"], "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS dl FROM post GROUP BY doc_id"),
    "avgs": (["lens"], "SELECT coalesce(avg(dl), 0.0) AS avgdl FROM lens"),
    "norms": (
        ["post", "terms"],
        """SELECT doc_id, sqrt(sum(tf * idf * tf * idf)) AS l2
            FROM post JOIN terms USING (term) GROUP BY doc_id""",
    ),
    "stop": (
        ["terms", "n"],
        f"SELECT term FROM terms, n WHERE df > CAST({STOPWORD_SHARE} AS DOUBLE) * n",
    ),
    "pairs": (
        ["words"],
        """SELECT doc_id, pos, token AS t1,
            lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS t2 FROM words""",
    ),
    "lexicon": (
        ["pairs"],
        f"""SELECT t1, t2, count(*) AS n FROM pairs WHERE t2 IS NOT NULL
            GROUP BY t1, t2 HAVING count(*) >= {LEXICON_COUNT}""",
    ),
    "passages": (
        [],
        """SELECT CASE WHEN item_id % 2 = 0 THEN 'train' ELSE 'test' END AS split,
            item_id AS qid, text AS question FROM benchmark""",
    ),
    "rels": (
        ["passages", "corpus"],
        """SELECT split, qid, doc_id, corpus.text AS context
            FROM passages JOIN corpus ON contains(corpus.text, question)""",
    ),
    "judged": (
        ["rels"],
        "SELECT split, qid, count(*) AS n_relevant FROM rels GROUP BY split, qid",
    ),
    # one row per question and block of ids, for what works on arrays
    "labels_": (
        ["passages", "rels"],
        f"""SELECT split, qid, doc_id // {LABEL_BLOCK} AS part, any_value(question) AS question,
            list(doc_id ORDER BY doc_id) AS cid FROM rels JOIN passages USING (split, qid)
            GROUP BY split, qid, part""",
    ),
}


def _compound(keys: str, pairs: str) -> str:
    """(keys, pos, token): greedy compounds of the pairs in the lexicon."""
    p_keys = ", ".join(f"p.{key}" for key in keys.split(", "))
    return f"""SELECT {keys}, pos,
        CASE WHEN starts THEN t1 || '_' || t2
             WHEN NOT coalesce(lag(starts) OVER (PARTITION BY {keys} ORDER BY pos), false)
             THEN t1 END AS token
      FROM (
        SELECT {keys}, pos, t1, t2, matched AND (row_number() OVER (
          PARTITION BY {keys}, matched, island ORDER BY pos) - 1) % 2 = 0 AS starts
        FROM (
          SELECT {p_keys}, p.pos, p.t1, p.t2, l.n IS NOT NULL AS matched,
            p.pos - row_number() OVER (
              PARTITION BY {p_keys}, l.n IS NOT NULL ORDER BY p.pos) AS island
          FROM {pairs} p LEFT JOIN lexicon l ON p.t1 = l.t1 AND p.t2 = l.t2))"""


def _question_words() -> str:
    return f"""SELECT split, qid, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos
        FROM (SELECT split, qid, {_words('question')} AS l FROM passages)"""


def _asked() -> dict[str, tuple[list[str], str]]:
    """Vectors and rankings for the questions."""
    return {
        "qwords": (["passages"], _question_words()),
        "qtok": (
            ["qwords"],
            f"""SELECT split, qid, token AS term, count(*) AS qtf FROM qwords
                WHERE {KEPT} GROUP BY split, qid, token""",
        ),
        "qvec": (
            ["qtok", "terms"],
            """SELECT split, qid, term, qtf, idf, bm25_idf, (1 + log10(qtf)) * idf AS qw,
                sqrt(sum(((1 + log10(qtf)) * idf) ** 2) OVER (PARTITION BY split, qid)) AS q_norm
                FROM qtok JOIN terms USING (term)""",
        ),
        "bm25": (
            ["qvec", "post", "lens", "avgs"],
            """SELECT 'bm25' AS method, split, qid, doc_id, round(sum({times} * bm25_idf
                * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
                FROM qvec JOIN post USING (term) JOIN lens USING (doc_id), avgs
                GROUP BY split, qid, doc_id""",
        ),
        "cosine": (
            ["qvec", "post", "norms"],
            """SELECT 'tfidf' AS method, split, qid, doc_id,
                round(sum(qw * tf * idf) / (max(q_norm) * max(l2)), 6) AS score
                FROM qvec JOIN post USING (term) JOIN norms USING (doc_id)
                GROUP BY split, qid, doc_id""",
        ),
        "scores": (["bm25", "cosine"], "SELECT * FROM bm25 UNION ALL SELECT * FROM cosine"),
        "ranking": (
            ["scores"],
            """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY method, split, qid
                ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores) WHERE rank <= 10""",
        ),
        "hits": (
            ["ranking", "judged", "rels"],
            """SELECT r.*, n_relevant, CASE WHEN t.doc_id IS NULL THEN 0 ELSE 1 END AS hit
                FROM ranking r JOIN judged j ON r.split = j.split AND r.qid = j.qid
                LEFT JOIN rels t
                ON r.split = t.split AND r.qid = t.qid AND r.doc_id = t.doc_id""",
        ),
        "gains": (
            ["hits"],
            """SELECT *, sum(hit) OVER (PARTITION BY method, split, qid ORDER BY rank) / rank
                AS prec FROM hits""",
        ),
        "ideal": (
            [],
            """SELECT i AS n, sum(1 / log2(i + 1)) OVER (ORDER BY i) AS idcg
                FROM range(1, 11) t(i)""",
        ),
        "metrics": (["gains", "ideal"], _metrics()),
        "summary": (
            ["metrics"],
            "SELECT method, count(*) AS num_queries, "
            + ", ".join(f"avg({c}) AS {c}" for c in _names())
            + " FROM metrics GROUP BY method",
        ),
        "long": (
            ["summary"],
            " UNION ALL ".join(
                f"""SELECT method, num_queries, mrr, map, CAST({k} AS INTEGER) AS k,
                p_{k} AS precision, r_{k} AS recall, ndcg_{k} AS ndcg FROM summary"""
                for k in (1, 5, 10)
            ),
        ),
    }


def _names() -> list[str]:
    return ["mrr", "map"] + [f"{m}_{k}" for k in (1, 5, 10) for m in ("p", "r", "ndcg")]


def _metrics() -> str:
    parts = [
        "coalesce(max(CASE WHEN hit = 1 THEN 1 / rank END), 0.0) AS mrr",
        "sum(CASE WHEN hit = 1 THEN prec ELSE 0.0 END) / n_relevant AS map",
    ]
    for k in (1, 5, 10):
        inside = f"hit = 1 AND rank <= {k}"
        parts += [
            f"count(CASE WHEN {inside} THEN 1 END) / {k} AS p_{k}",
            f"count(CASE WHEN {inside} THEN 1 END) / n_relevant AS r_{k}",
            f"""sum(CASE WHEN {inside} THEN 1 / log2(rank + 1) ELSE 0.0 END)
            / (SELECT idcg FROM ideal WHERE n = least(n_relevant, {k})) AS ndcg_{k}""",
        ]
    return (
        f"SELECT method, split, qid, {', '.join(parts)} FROM gains"
        " GROUP BY method, split, qid, n_relevant"
    )


# What depends on the tokens; a variant of the text preparation has its own copies.
DERIVED = "post terms lens avgs norms qtok qvec bm25 cosine scores ranking".split()


def _variant(blocks: dict, stopped: bool) -> dict:
    """Blocks named x_v instead of x: compounds joined, and stopwords dropped as well."""
    renamed = re.compile(r"(?<!')\b(" + "|".join(DERIVED) + r")\b(?! *\()")
    new = {
        "comp": (["pairs", "lexicon"], _compound("doc_id", "pairs")),
        "qpairs": (
            ["qwords"],
            """SELECT split, qid, pos, token AS t1,
                lead(token) OVER (PARTITION BY split, qid ORDER BY pos) AS t2 FROM qwords""",
        ),
        "qcomp": (["qpairs", "lexicon"], _compound("split, qid", "qpairs")),
    }
    kept = f"token IS NOT NULL AND {KEPT}" + " AND token NOT IN (SELECT term FROM stop)" * stopped
    stop = ["stop"] * stopped
    for name in DERIVED:
        needs, text = blocks[name]
        needs = [f"{n}_v" if n in DERIVED else n for n in needs]
        new[f"{name}_v"] = (needs, renamed.sub(r"\1_v", text))
    new["post_v"] = (
        ["comp", *stop],
        f"SELECT doc_id, token AS term, count(*) AS tf FROM comp WHERE {kept} GROUP BY doc_id, token",
    )
    new["qtok_v"] = (
        ["qcomp", *stop],
        f"""SELECT split, qid, token AS term, count(*) AS qtf FROM qcomp WHERE {kept}
            GROUP BY split, qid, token""",
    )
    return new


def _sql(select: str, needs: list[str], times: str = "qtf", stopped: bool = False) -> str:
    blocks = BLOCKS | _asked()
    blocks |= _variant(blocks, stopped)
    order: list[str] = []

    def add(name: str) -> None:
        for need in blocks[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return select
    parts = [
        f"{name} AS MATERIALIZED ({blocks[name][1].replace('{times}', times)})" for name in order
    ]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _rounded(names: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in names)


FIRST_QUESTION = "qid = (SELECT min(item_id) FROM benchmark)"


def oracle_sql() -> dict[str, str]:
    ranked = "split, qid, rank, doc_id, score FROM ranking"
    metric_values = _rounded(_names())
    long_values = "method, num_queries, k, " + _rounded(
        ["mrr", "map", "precision", "recall", "ndcg"]
    )
    return {
        "corpus_profile": """SELECT count(*) AS n_rows,
            count(DISTINCT doc_id) + coalesce(max((doc_id IS NULL)::INT), 0) AS n_ids,
            count(DISTINCT text) + coalesce(max((text IS NULL)::INT), 0) AS n_texts
            FROM documents""",
        "corpus_describe": " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS stddev, min({c})::VARCHAR AS min,
            max({c})::VARCHAR AS max FROM documents"""
            for c in ("doc_id", "n_chars")
        ),
        "labels_describe": _sql(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS "column", count({c}) AS count, {mean} AS mean,
                {deviation} AS stddev, min({c})::VARCHAR AS min, max({c})::VARCHAR AS max
                FROM passages"""
                for c, mean, deviation in (
                    ("split", "NULL::DOUBLE", "NULL::DOUBLE"),
                    ("qid", "round(avg(qid), 6)", "round(stddev_samp(qid), 6)"),
                    ("question", "NULL::DOUBLE", "NULL::DOUBLE"),
                )
            ),
            ["passages"],
        ),
        "corpus_point_lookup": f"""SELECT doc_id AS cid, text FROM documents
            WHERE doc_id = {LOOKUP_ID}""",
        "corpus_sample_limit": _sql(
            f"SELECT doc_id, text FROM corpus ORDER BY doc_id LIMIT {SAMPLE_ROWS}", ["corpus"]
        ),
        "corpus_sample_cutoff": _sql(
            f"SELECT doc_id, text FROM corpus WHERE doc_id <= {CUTOFF}", ["corpus"]
        ),
        "labels_array_cutoff": _sql(
            f"""SELECT split, qid, part, question, array_to_string(cid, ',') AS cid FROM (
            SELECT split, qid, part, question, list_filter(cid, lambda i: i <= {CUTOFF}) AS cid
            FROM labels_) WHERE len(cid) > 0""",
            ["labels_"],
        ),
        "labels_bitmap_cutoff": _sql(
            f"SELECT split, qid, count(*) AS n_ids FROM rels WHERE doc_id <= {CUTOFF} GROUP BY split, qid",
            ["rels"],
        ),
        "sample_consistent_qrels": _sql(
            f"""SELECT split, qid, doc_id FROM rels WHERE doc_id IN
            (SELECT doc_id FROM corpus ORDER BY doc_id LIMIT {SAMPLE_ROWS})""",
            ["rels"],
        ),
        "reduce_tables_roundtrip": _sql(
            f"""SELECT 'corpus' AS name, doc_id AS id, (-1)::BIGINT AS part, text AS content
            FROM documents WHERE doc_id <= {CUTOFF} UNION ALL
            SELECT 'labels', qid, part, array_to_string(cid, ',') FROM (
            SELECT qid, part, list_filter(cid, lambda i: i <= {CUTOFF}) AS cid FROM labels_)
            WHERE len(cid) > 0""",
            ["labels_"],
        ),
        "tokens_clean": _sql("SELECT doc_id, pos, token FROM tok", ["tok"]),
        "tokens_nfc": _sql(
            "SELECT doc_id, nfc_normalize(coalesce(text, '')) AS text FROM corpus", ["corpus"]
        ),
        "docs_token_string": _sql(
            """SELECT doc_id, coalesce(content, '') AS content, coalesce(dl, 0) AS dl
            FROM corpus LEFT JOIN (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS content,
            count(*) AS dl FROM tok GROUP BY doc_id) USING (doc_id)""",
            ["tok"],
        ),
        "tokens_no_stopwords": _sql(
            """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos,
            token FROM tok WHERE token NOT IN (SELECT term FROM stop)""",
            ["tok", "stop"],
        ),
        "lexicon_learn": _sql("SELECT t1, t2, n FROM lexicon", ["lexicon"]),
        "stopwords_load": _sql(
            "SELECT term FROM stop UNION SELECT t1 || '_' || t2 FROM lexicon",
            ["stop", "lexicon"],
        ),
        "tokens_compound": _sql(
            f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos,
            token FROM comp WHERE token IS NOT NULL AND {KEPT}""",
            ["comp"],
        ),
        "postings_positions": _sql(
            """SELECT doc_id, token AS term, string_agg(pos, ',' ORDER BY pos) AS positions
            FROM tok GROUP BY doc_id, token""",
            ["tok"],
        ),
        "vocabulary": _sql("SELECT DISTINCT token AS term FROM tok", ["tok"]),
        "tf": _sql("SELECT doc_id, term, tf FROM post", ["post"]),
        "term_stats": _sql(f"SELECT term, df, {_rounded(['idf', 'bm25_idf'])} FROM terms", ["terms"]),
        "tfidf_weights": _sql(
            "SELECT doc_id, term, round(tf * idf, 6) AS w FROM post JOIN terms USING (term)",
            ["post", "terms"],
        ),
        "doc_l2": _sql("SELECT doc_id, round(l2, 6) AS l2 FROM norms", ["norms"]),
        "tfidf_normalized": _sql(
            """SELECT doc_id, term, round(tf * idf / l2, 6) AS w_norm
            FROM post JOIN terms USING (term) JOIN norms USING (doc_id)""",
            ["post", "terms", "norms"],
        ),
        "doc_token_counts": _sql(
            """SELECT doc_id, coalesce(dl, 0) AS dl
            FROM corpus LEFT JOIN lens USING (doc_id)""",
            ["corpus", "lens"],
        ),
        "corpus_stats": _sql(
            """SELECT n AS n_docs, (SELECT count(*) FROM lens) AS n_nonempty,
            round(avgdl, 6) AS avgdl, (SELECT count(*) FROM terms) AS n_terms FROM n, avgs""",
            ["n", "avgs", "lens", "terms"],
        ),
        "index_roundtrip": _sql(
            """SELECT doc_id, term, tf, dl, round(l2, 6) AS l2, round(idf, 6) AS idf
            FROM post JOIN terms USING (term) JOIN lens USING (doc_id)
            JOIN norms USING (doc_id)""",
            ["post", "terms", "lens", "norms"],
        ),
        "query_terms": _sql("SELECT split, qid, term, qtf FROM qvec", ["qvec"]),
        "query_vectors": _sql(
            f"SELECT split, qid, term, qtf, {_rounded(['qw', 'q_norm'])} FROM qvec", ["qvec"]
        ),
        "candidate_counts": _sql(
            """SELECT split, qid, count(DISTINCT doc_id) AS n_candidates
            FROM qvec JOIN post USING (term) GROUP BY split, qid""",
            ["qvec", "post"],
        ),
        "candidate_documents": _sql(
            """SELECT doc_id, dl FROM lens WHERE doc_id IN
            (SELECT doc_id FROM qvec JOIN post USING (term))""",
            ["lens", "qvec", "post"],
        ),
        "rank_cosine_one": _sql(
            f"""SELECT rank, doc_id, score FROM ranking
            WHERE method = 'tfidf' AND {FIRST_QUESTION}""",
            ["ranking"],
        ),
        "rank_bm25_one": _sql(
            f"""SELECT rank, doc_id, score FROM ranking
            WHERE method = 'bm25' AND {FIRST_QUESTION}""",
            ["ranking"],
            times="1",
        ),
        "rank_cosine_all": _sql(f"SELECT {ranked} WHERE method = 'tfidf'", ["ranking"]),
        "rank_bm25_distinct": _sql(
            f"SELECT {ranked} WHERE method = 'bm25'", ["ranking"], times="1"
        ),
        "rank_bm25_multiplicity": _sql(
            f"SELECT {ranked} WHERE method = 'bm25'", ["ranking"]
        ),
        "rank_both": _sql(f"SELECT method, {ranked}", ["ranking"]),
        "rank_bounded": _sql(f"SELECT method, {ranked}", ["ranking"]),
        "rank_bm25_compound": _sql(
            "SELECT split, qid, rank, doc_id, score FROM ranking_v WHERE method = 'bm25'",
            ["ranking_v"],
        ),
        "rank_both_stopwords": _sql(
            "SELECT method, split, qid, rank, doc_id, score FROM ranking_v",
            ["ranking_v"],
            stopped=True,
        ),
        "rank_arrays": _sql(
            """SELECT method, split, qid, string_agg(doc_id, ',' ORDER BY rank) AS retrieved
            FROM ranking GROUP BY method, split, qid""",
            ["ranking"],
        ),
        "rank_excerpts": _sql(
            """SELECT method, split, qid, rank, doc_id, score,
            left(coalesce(content, 'No content available'), 100) || '...' AS excerpt
            FROM ranking LEFT JOIN (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS content
            FROM tok GROUP BY doc_id) USING (doc_id)""",
            ["ranking", "tok"],
        ),
        "qrels": _sql(
            """SELECT DISTINCT 'q' || qid AS query_id, 'c' || doc_id AS corpus_id,
            CAST(1 AS INTEGER) AS rel FROM rels""",
            ["rels"],
        ),
        "qrels_truth_sets": _sql("SELECT split, qid, n_relevant FROM judged", ["judged"]),
        "query_lookup": _sql(
            """SELECT 'q' || qid AS query_id, question FROM passages
            WHERE (split, qid) IN (SELECT (split, qid) FROM rels)""",
            ["passages", "rels"],
        ),
        "contexts_exploded": _sql(
            """SELECT qid, question, context FROM rels JOIN passages USING (split, qid)""",
            ["rels"],
        ),
        "contexts_distinct": _sql("SELECT DISTINCT context FROM rels", ["rels"]),
        "contexts_dedup": _sql(
            """SELECT len(ids) AS n_ids, ids[1] AS first_id, min(context) AS context
            FROM (SELECT split, qid, list(doc_id ORDER BY doc_id) AS ids FROM rels
            GROUP BY split, qid) JOIN rels USING (split, qid) GROUP BY ids""",
            ["rels"],
        ),
        "train_test_union": _sql(
            """SELECT split, qid, question, coalesce(n_relevant, 0) AS n_relevant
            FROM passages LEFT JOIN judged USING (split, qid)""",
            ["passages", "judged"],
        ),
        "metrics_per_query": _sql(
            f"SELECT method, split, qid, {metric_values} FROM metrics", ["metrics"]
        ),
        "metrics_summary": _sql(
            f"SELECT method, num_queries, {metric_values} FROM summary", ["summary"]
        ),
        "metrics_long": _sql(f"SELECT {long_values} FROM long", ["long"]),
        "summary_csv_roundtrip": _sql(f"SELECT {long_values} FROM long", ["long"]),
        "results_json_roundtrip": _sql(
            f"""SELECT method, split, qid, question AS query, {metric_values}, retrieved
            FROM metrics JOIN (SELECT method, split, qid,
            string_agg(doc_id, ',' ORDER BY rank) AS retrieved
            FROM ranking GROUP BY method, split, qid) USING (method, split, qid)
            JOIN passages USING (split, qid)""",
            ["metrics", "ranking", "passages"],
        ),
        "export_json_roundtrip": _sql(
            """SELECT 'corpus' AS name, doc_id AS id, (-1)::BIGINT AS part, text AS content
            FROM corpus UNION ALL
            SELECT 'questions', qid, part, concat_ws('|', question, array_to_string(cid, ','))
            FROM labels_ WHERE split = 'test'""",
            ["corpus", "labels_"],
        ),
    }
