"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from reviewloom.params import PROMPT_EXCERPT, PROMPT_HEADER, TOPICS
from reviewloom.plans.queries import AD_HOC, HEAD, HEAD_LINES, INSIGHTS, SELECTION

_SPACE = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_ENDS = f"^{_SPACE}|{_SPACE}$"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _topic_rows(topics: dict[str, str]) -> str:
    return ", ".join(f"({_quote(t)}, {_quote(k)})" for t, k in topics.items())


def _reviews(business: str = "source", where: str = "true") -> dict[str, str]:
    """Named steps from documents to chunks."""
    replaced = "stripped"
    for old, new in ((r"chr(160)", "' '"), ("'+'", "''"), ("chr(11)", "' '"),
                     ("chr(8220)", "'\"'"), ("chr(8217)", "''''")):
        replaced = f"replace({replaced}, {old}, {new})"
    return {
        "reviews": f"""
            SELECT cast(doc_id AS varchar) AS review_id, {business} AS business_id, source AS name,
                   cast(1 + doc_id % 5 AS double) AS stars, doc_id AS ordinal, text,
                   cast(date '2020-01-01' + cast(doc_id % 365 AS int) AS varchar) AS date
            FROM documents WHERE {where}""",
        "cleaned": f"""
            SELECT * EXCLUDE (text, stripped), regexp_replace(
                regexp_replace({replaced}, '{_SPACE}', ' ', 'g'), '{_ENDS}', '', 'g') AS text
            FROM (SELECT *, regexp_replace(text, '{_ENDS}', '', 'g') AS stripped FROM reviews)
            WHERE length(stripped) >= 30""",
        "uniq": """
            SELECT * FROM cleaned
            QUALIFY row_number() OVER (PARTITION BY text ORDER BY ordinal) = 1""",
    }


_CHUNKS = {
    "numbered": """
        SELECT *, unnest(range((length(text) - 1) // 800 + 1)) AS i FROM uniq WHERE text <> ''""",
    "cut": """
        SELECT *, CASE WHEN i = 0 THEN substring(text, 1, 1000)
                       ELSE substring(text, 800 * i - 199, 1000) END AS chunk
        FROM numbered
        WHERE i = 0 OR (length(text) > 1000 AND length(text) - 800 * i + 200 > 230)""",
    "chunks": """
        SELECT i AS chunk_index, chunk, business_id, review_id, name AS restaurant_name,
               review_id || '_' || i AS chunk_id, length(chunk) AS n_chars, stars, date,
               md5(text) || '_' || i AS chunk_key
        FROM cut""",
}


def _weights(source: str, key: str, text: str, out: str) -> dict[str, str]:
    """Unit-length md5 bucket counts as (key, bucket, w)."""
    return {
        f"{out}_counts": f"""
            SELECT {key}, ('0x' || substring(md5(token), 1, 4))::int % 64 AS bucket, count(*) AS n
            FROM (SELECT {key}, unnest(string_split_regex(lower({text}), '[^a-zà-ÿ0-9]+')) AS token
                  FROM {source})
            WHERE token <> '' GROUP BY 1, 2""",
        out: f"""
            SELECT {key}, bucket,
                   cast(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS float) AS w
            FROM {out}_counts""",
    }


def _topics(topics: dict[str, str] = TOPICS) -> dict[str, str]:
    return {
        "topics": f"SELECT * FROM (VALUES {_topic_rows(topics)}) t(topic, keywords)",
        **_weights("topics", "topic", "keywords", "qvec"),
    }


_RETRIEVED = {
    **_weights("chunks", "chunk_id", "chunk", "cvec"),
    "products": """
        SELECT chunk_id, topic, sum(c.w::double * q.w::double) AS s
        FROM cvec c JOIN qvec q USING (bucket) GROUP BY 1, 2""",
    "scored": """
        SELECT c.*, t.topic, round(coalesce(p.s, 0), 9) AS score
        FROM chunks c CROSS JOIN topics t
        LEFT JOIN products p ON p.chunk_id = c.chunk_id AND p.topic = t.topic""",
    "topk": """
        SELECT * FROM scored QUALIFY row_number() OVER (
            PARTITION BY business_id, topic ORDER BY score DESC, chunk_id) <= 25""",
    "capped": """
        SELECT * FROM topk QUALIFY row_number() OVER (
            PARTITION BY business_id, topic, review_id ORDER BY score DESC, chunk_id) <= 1""",
    "found": """
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY business_id, topic ORDER BY score DESC, chunk_id) AS rank FROM capped)
        WHERE rank <= 12""",
}

_STORED = {
    "vectors": """
        SELECT cast(vec_id AS varchar) AS chunk_id, cast(label AS varchar) AS business_id,
               cast(vec_id // 3 AS varchar) AS review_id, embedding FROM embeddings""",
    "places": """
        SELECT chunk_id, unnest(embedding)::double AS x, unnest(range(len(embedding))) AS bucket
        FROM vectors""",
}


def _stored_scores(value: str) -> dict[str, str]:
    return {
        "scored": f"""
            SELECT v.chunk_id, v.business_id, v.review_id, s.topic, round(s.score, 9) AS score
            FROM vectors v JOIN (
                SELECT chunk_id, t.topic, {value} AS score
                FROM places p CROSS JOIN topics t
                LEFT JOIN qvec q ON q.topic = t.topic AND q.bucket = p.bucket
                GROUP BY 1, 2) s USING (chunk_id)""",
    }


_IP = "sum(x * coalesce(q.w, 0)::double)"
_COSINE = f"{_IP} / (sqrt(sum(x * x)) * sqrt(sum(coalesce(q.w, 0)::double ** 2)))"
_L2 = "sum((x - coalesce(q.w, 0)::double) ** 2)"


def _long(found: str = "found") -> dict[str, str]:
    return {
        "pairs": f"""
            SELECT business_id, min(restaurant_name) AS restaurant_name, t.topic
            FROM {found} CROSS JOIN topics t GROUP BY business_id, t.topic""",
        "facts": f"""
            SELECT business_id, topic, avg(stars) AS mean_stars,
                   string_agg(regexp_extract(chunk, '^[^.!?]*[.!?]?'), ' ' ORDER BY rank) AS sentences
            FROM {found} GROUP BY 1, 2""",
        "long": f"""
            SELECT business_id, restaurant_name, topic, replace(regexp_replace(coalesce(
                       CASE WHEN mean_stars >= 3.5 THEN 'Positive'
                            WHEN mean_stars <= 2.5 THEN 'Negative' ELSE 'Mixed' END
                       || ' reviews. ' || sentences,
                       topic || ' details are limited in the provided reviews.'),
                       '{_ENDS}', '', 'g'), chr(10), ' ') AS summary
            FROM pairs LEFT JOIN facts USING (business_id, topic)""",
        "wide": """
            SELECT business_id, restaurant_name,
                   max(summary) FILTER (topic = 'food') AS food,
                   max(summary) FILTER (topic = 'service') AS service,
                   max(summary) FILTER (topic = 'ambiance') AS ambiance
            FROM long GROUP BY 1, 2""",
        "by_name": """
            SELECT restaurant_name, food, service, ambiance FROM wide
            QUALIFY row_number() OVER (PARTITION BY restaurant_name ORDER BY business_id DESC) = 1""",
    }


def _prompts() -> dict[str, str]:
    head = f"replace({_quote(PROMPT_HEADER)}, '@NAME@', restaurant_name)"
    head = f"replace(replace({head}, '@TOPIC@', upper(topic)), '@topic@', topic)"
    part = f"replace({_quote(PROMPT_EXCERPT)}, '@I@', cast(rank - 1 AS varchar))"
    part = f"replace(replace({part}, '@STARS@', coalesce(cast(stars AS varchar), '')), '@CHUNK@', chunk)"
    return {
        "pairs": """
            SELECT business_id, min(restaurant_name) AS restaurant_name, t.topic
            FROM found CROSS JOIN topics t GROUP BY business_id, t.topic""",
        "excerpts": f"""
            SELECT business_id, topic, string_agg({part}, '' ORDER BY rank) AS excerpts, count(*) AS n
            FROM found GROUP BY 1, 2""",
        "prompts": f"""
            SELECT business_id, restaurant_name, topic,
                   {head} || coalesce(excerpts, '') AS prompt, coalesce(n, 0) AS n_excerpts
            FROM pairs LEFT JOIN excerpts USING (business_id, topic)""",
    }


def _sql(final: str, *steps: dict[str, str]) -> str:
    named = {name: body for group in steps for name, body in group.items()}
    if not named:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in named.items()) + "\n" + final


_SOURCE = _reviews()
_LANG = _reviews("source || '-' || lang")
_THIRDS = _LANG | {"reviews": _LANG["reviews"].replace("cast(doc_id AS varchar)", "cast(doc_id // 3 AS varchar)")}
_GOOD = _reviews(
    "source || '-' || lang", "doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"
)
_SEARCH = (_SOURCE, _CHUNKS, _topics(), _RETRIEVED)
_SUMMARIES = (_LANG, _CHUNKS, _topics(), _RETRIEVED, _long())
_FOUND = "round(score, 6) AS score, rank, chunk_id, business_id, restaurant_name, stars, review_id, chunk"

_ELIGIBLE = {
    "eligible": f"""
        SELECT l_partkey AS business_id, count(DISTINCT l_orderkey) AS n_items FROM lineitem
        GROUP BY 1 HAVING count(DISTINCT l_orderkey) > {SELECTION.min_reviews}""",
}
_WANTED_PARTS = f"""lower(p_name) LIKE '%{SELECTION.include}%'
    AND NOT regexp_matches(lower(p_name), '{SELECTION.exclude}')"""
_CHOSEN = {
    "chosen": f"""
        SELECT l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {_WANTED_PARTS}
        GROUP BY 1 HAVING count(DISTINCT l_orderkey) > {SELECTION.min_reviews}
        ORDER BY md5('1:' || l_partkey), l_partkey LIMIT {SELECTION.n_entities}""",
}
_JOINED_PARTS = """l_partkey AS business_id, l_orderkey AS review_id, l_linenumber::bigint AS line,
    l_quantity AS stars_reviews, p_name AS name, p_retailprice AS stars_restaurant
    FROM lineitem JOIN part ON p_partkey = l_partkey"""
_EDGES = "(0, 0, 5, '0-5'), (1, 5, 10, '6-10'), (2, 10, 20, '11-20'), (3, 20, 50, '21-50'), " \
    "(4, 50, 80, '51-80'), (5, 80, 100, '81-100'), (6, 100, 1e18, '100+')"  # fmt: skip


def _keyed(steps: dict[str, str]) -> dict[str, str]:
    """Chunks under a key of text and index in place of the review id, which may repeat."""
    return {n: b.replace("chunk_id) <=", "chunk_id, chunk_key) <=").replace("chunk_id) AS rank", "chunk_id, chunk_key) AS rank")
            .replace("SELECT chunk_id,", "SELECT chunk_key,").replace("GROUP BY chunk_id", "GROUP BY chunk_key")
            .replace("p.chunk_id = c.chunk_id", "p.chunk_key = c.chunk_key").replace("PARTITION BY chunk_id", "PARTITION BY chunk_key")
            for n, b in steps.items()}


def _insights(chosen: str, reviews: dict[str, str]) -> str:
    """The whole run over drawn or all eligible businesses."""
    selected = reviews["reviews"] + f" AND source || '-' || lang IN (SELECT business_id FROM {chosen})"
    entities = {
        "businesses": """
            SELECT source || '-' || lang AS business_id, min(lang) AS categories
            FROM documents GROUP BY 1""",
        "all_reviews": reviews["reviews"],
        "eligible": f"""
            SELECT business_id FROM businesses JOIN all_reviews USING (business_id)
            WHERE lower(categories) LIKE '%{INSIGHTS.include}%'
              AND NOT regexp_matches(lower(categories), '{INSIGHTS.exclude}')
            GROUP BY 1 HAVING count(DISTINCT review_id) > {INSIGHTS.min_reviews}""",
        "drawn": f"""
            SELECT business_id FROM eligible
            ORDER BY md5('{INSIGHTS.seed}:' || business_id), business_id LIMIT {INSIGHTS.n_entities}""",
    }
    return _sql(
        "SELECT * FROM by_name",
        entities,
        reviews | {"reviews": selected},
        _keyed(_CHUNKS),
        _topics(),
        _keyed(_RETRIEVED),
        _long(),
    )


def _stage(name: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS stage, count(*) AS n_rows, "
        f"count(DISTINCT business_id) AS n_keys FROM {source}"
    )


_ROUND_TRIP = "review_id, business_id, name, stars AS stars_reviews, date, text"

ORACLES: dict[str, str] = {
    "head_rows": f"SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT {HEAD}",
    "json_props": "SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events",
    "drop_any_null": """
        SELECT doc_id, source, quality::bigint AS quality, toxic::bigint AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)
        WHERE source IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""",
    "join_suffix": """
        SELECT o_custkey AS business_id, o_orderkey AS review_id,
               o_totalprice AS amount_reviews, c_acctbal AS amount_restaurant
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "review_business_join": f"SELECT {_JOINED_PARTS}",
    "hot_key_join": f"SELECT {_JOINED_PARTS}".replace(
        "lineitem", "(SELECT * REPLACE (CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE l_partkey END AS l_partkey) FROM lineitem) lineitem"
    ),
    "category_filter": f"""
        SELECT p_partkey AS business_id, p_name AS name FROM part WHERE {_WANTED_PARTS}""",
    "eligible_keys": _sql("SELECT * FROM eligible", _ELIGIBLE),
    "sample_entities": _sql(
        """SELECT business_id FROM eligible
           ORDER BY md5('1:' || business_id), business_id LIMIT 10""",
        _ELIGIBLE,
    ),
    "select_entities": _sql(
        f"SELECT {_JOINED_PARTS} WHERE l_partkey IN (SELECT l_partkey FROM chosen)", _CHOSEN
    ),
    "union_batches": """
        SELECT cast(doc_id AS varchar) AS review_id, source, length(text) AS n_chars FROM documents
        UNION ALL
        SELECT conv_id || '-' || turn, NULL, length(text) FROM conversations""",
    "clean_text": _sql("SELECT review_id, text FROM cleaned", _SOURCE),
    "clean_unicode": _sql(
        "SELECT review_id, text FROM cleaned",
        _SOURCE | {"reviews": _SOURCE["reviews"].replace(" text,", " replace(text, chr(10), ' ') AS text,")},
    ),
    "dedup_text": _sql("SELECT review_id, text FROM uniq", _SOURCE),
    "cleaning_counted": _sql(
        """SELECT *, n_input - n_clean AS dropped_cleaning, n_clean - n_unique AS dropped_dedup
           FROM (SELECT (SELECT count(*) FROM reviews) AS n_input, (SELECT count(*) FROM cleaned) AS n_clean,
                        (SELECT count(*) FROM uniq) AS n_unique)""",
        _SOURCE,
    ),
    "json_lines": _sql(f"SELECT {_ROUND_TRIP} FROM reviews", _SOURCE),
    "json_head": _sql(f"SELECT {_ROUND_TRIP} FROM reviews ORDER BY ordinal LIMIT {HEAD_LINES}", _SOURCE),
    "csv_round_trip": _sql(f"SELECT {_ROUND_TRIP} FROM reviews", _SOURCE),
    "parquet_round_trip": _sql(f"SELECT {_ROUND_TRIP}, ordinal FROM reviews", _SOURCE),
    "vector_refresh": _sql(
        """SELECT chunk_id, business_id, review_id, round(CASE WHEN business_id = (SELECT min(business_id) FROM vectors)
                  THEN (embedding[1] / 2)::float ELSE embedding[1] END::double, 6) AS first FROM vectors""",
        _STORED,
    ),
    "bucketed_lookup": _sql(
        f"SELECT topic, {_FOUND} FROM found WHERE business_id = (SELECT min(business_id) FROM reviews)", *_SEARCH
    ),
    "index_differences": """
        WITH m AS (SELECT label, CASE WHEN vec_id % 97 = 5 THEN vec_id + 1000000007 ELSE vec_id END AS vec_id FROM embeddings)
        SELECT label::bigint AS business_id, vec_id AS chunk_key, 'metadata' AS missing
        FROM (SELECT label, vec_id FROM embeddings EXCEPT SELECT label, vec_id FROM m)
        UNION ALL
        SELECT label, vec_id, 'vector' FROM (SELECT label, vec_id FROM m EXCEPT SELECT label, vec_id FROM embeddings)""",
    "chunk_first": _sql(
        """SELECT 0::bigint AS chunk_index, substring(text, 1, 1000) AS chunk, business_id, review_id,
                  name AS restaurant_name, review_id || '_0' AS chunk_id,
                  length(substring(text, 1, 1000)) AS n_chars, stars, date,
                  md5(text) || '_0' AS chunk_key
           FROM uniq WHERE text <> ''""",
        _SOURCE,
    ),
    "chunk_sliding": _sql("SELECT * FROM chunks", _SOURCE, _CHUNKS),
    "cleaning_report": _sql(
        """SELECT n_input, n_clean, n_unique, n_input - n_clean AS dropped_cleaning,
                  n_clean - n_unique AS dropped_dedup
           FROM (SELECT (SELECT count(*) FROM reviews) AS n_input,
                        (SELECT count(*) FROM cleaned) AS n_clean,
                        (SELECT count(*) FROM uniq) AS n_unique)""",
        _SOURCE,
    ),
    "embed_hashed": _sql(
        "SELECT chunk_id, bucket::bigint AS bucket, round(w::double, 6) AS weight FROM cvec",
        _SOURCE,
        _CHUNKS,
        _weights("chunks", "chunk_id", "chunk", "cvec"),
    ),
    "embed_topics": _sql(
        "SELECT topic, bucket::bigint AS bucket, round(w::double, 6) AS weight FROM qvec",
        {"topics": "SELECT item_id AS topic, text AS keywords FROM benchmark"},
        _weights("topics", "topic", "keywords", "qvec"),
    ),
    "normalize_vectors": _sql(
        """SELECT vec_id, bucket,
                  round((x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)))::float::double, 6) AS weight
           FROM places""",
        {
            "places": """
                SELECT vec_id, unnest(range(len(embedding))) AS bucket,
                       (unnest(embedding)::double * (label + 1))::float::double AS x
                FROM embeddings"""
        },
    ),
    **{
        name: _sql(
            """SELECT chunk_id, business_id, review_id, topic, round(score, 6) AS score
               FROM scored""",
            _STORED,
            _topics(),
            _stored_scores(value),
        )
        for name, value in (("score_topics", _IP), ("score_cosine", _COSINE), ("score_l2", _L2))
    },
    "score_many": _sql(
        """SELECT chunk_id, business_id, review_id, topic, round(score, 6) AS score FROM scored
           QUALIFY row_number() OVER (
               PARTITION BY business_id, topic ORDER BY score DESC, chunk_id) = 1""",
        _STORED,
        {"topics": "SELECT cast(item_id AS varchar) AS topic, text AS keywords FROM benchmark"},
        _weights("topics", "topic", "keywords", "qvec"),
        _stored_scores(_IP),
    ),
    "topic_topk": _sql(
        """SELECT chunk_id, business_id, review_id, topic, round(score, 6) AS score FROM scored
           QUALIFY row_number() OVER (
               PARTITION BY business_id, topic ORDER BY score DESC, chunk_id) <= 25""",
        _STORED,
        _topics(),
        _stored_scores(_IP),
    ),
    "batch_retrieval": _sql(f"SELECT topic, {_FOUND} FROM found", *_SEARCH),
    "topic_retrieval": _sql(f"SELECT topic, {_FOUND} FROM found", *_SEARCH),
    "retrieval_l2": _sql(
        """SELECT topic, round(score, 6) AS score, rank, chunk_id, business_id, review_id FROM (
               SELECT *, row_number() OVER (
                   PARTITION BY business_id, topic ORDER BY score, chunk_id) AS rank
               FROM (SELECT * FROM near QUALIFY row_number() OVER (
                   PARTITION BY business_id, topic, review_id ORDER BY score, chunk_id) <= 1))
           WHERE rank <= 12""",
        _STORED,
        _topics(),
        _stored_scores(_L2),
        {
            "near": """
                SELECT * FROM scored QUALIFY row_number() OVER (
                    PARTITION BY business_id, topic ORDER BY score, chunk_id) <= 25"""
        },
    ),
    "adhoc_search": _sql(
        """SELECT chunk_id, business_id, chunk, topic, round(score, 6) AS score,
                  row_number() OVER (ORDER BY score DESC, chunk_id) AS rank
           FROM scored
           WHERE business_id = (SELECT source FROM documents GROUP BY source
                                ORDER BY md5('42:' || source), source LIMIT 1)
           ORDER BY score DESC, chunk_id LIMIT 5""",
        _SOURCE,
        _CHUNKS,
        _topics({"query": AD_HOC}),
        _RETRIEVED,
    ),
    "sample_per_topic": _sql(
        """SELECT topic, chunk_id, business_id, chunk FROM found
           QUALIFY row_number() OVER (
               PARTITION BY topic ORDER BY md5('1:' || chunk_id), chunk_id) = 1""",
        *_SEARCH,
    ),
    "vector_metadata_join": """
        SELECT cast(vec_id AS varchar) AS chunk_id, cast(label AS varchar) AS business_id,
               cast(vec_id // 3 AS varchar) AS review_id, source, n_chars
        FROM embeddings JOIN documents ON doc_id = vec_id""",
    "index_lookup": """
        SELECT source AS business_id, count(l.doc_id) AS n_vectors, count(*) AS n_metadata,
               count(l.doc_id) = count(*) AS paired
        FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""",
    "index_integrity": """
        SELECT vec_id AS chunk_id, 'metadata' AS missing FROM embeddings
        WHERE vec_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL
        SELECT doc_id, 'vector' FROM labels WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
    "index_stats": _sql(
        """SELECT business_id, count(*) AS n_vectors, min(dim) AS min_dim, max(dim) AS max_dim,
                  round(min(norm), 6) AS min_norm, round(max(norm), 6) AS max_norm
           FROM (SELECT business_id, chunk_id, count(*) AS dim, sqrt(sum(x * x)) AS norm
                 FROM places JOIN vectors USING (chunk_id) GROUP BY 1, 2)
           GROUP BY 1""",
        _STORED,
    ),
    "empty_topics": _sql(
        """SELECT DISTINCT source || '-' || lang AS business_id, topic
           FROM documents CROSS JOIN topics
           WHERE NOT EXISTS (SELECT 1 FROM found f
                             WHERE f.business_id = source || '-' || lang AND f.topic = topics.topic)""",
        _GOOD,
        _CHUNKS,
        _topics(),
        _RETRIEVED,
    ),
    "run_report": _sql(
        " UNION ALL ".join(
            _stage(n, t)
            for n, t in (
                ("reviews", "reviews"), ("clean", "cleaned"), ("unique", "uniq"), ("chunks", "chunks"),
            )
        ),
        _SOURCE,
        _CHUNKS,
    ),
    "count_histogram": f"""
        SELECT bin::bigint AS bin, label, count(n) AS n_keys
        FROM (VALUES {_EDGES}) e(bin, low, high, label)
        LEFT JOIN (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_partkey)
               ON n > low AND n <= high
        GROUP BY 1, 2""",
    "counts_by_name": """
        SELECT p_name AS name, count(DISTINCT l_orderkey) AS n_items
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""",
    "distinct_names": """
        SELECT p_partkey, p_name, p_brand, p_type FROM part
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1""",
    "entity_list": _sql("SELECT DISTINCT business_id FROM uniq WHERE text <> ''", _SOURCE),
    "topic_prompts": _sql("SELECT * FROM prompts", *_SEARCH, _prompts()),
    "topic_prompts_nulls": _sql(
        "SELECT * FROM prompts",
        _SOURCE | {"reviews": _SOURCE["reviews"].replace(
            "cast(1 + doc_id % 5 AS double)", "CASE WHEN doc_id % 3 <> 0 THEN cast(1 + doc_id % 5 AS double) END")},
        *_SEARCH[1:],
        _prompts(),
    ),
    "summaries_long": _sql("SELECT * FROM long", *_SUMMARIES),
    "summary_pivot": _sql("SELECT * FROM wide", *_SUMMARIES),
    "summary_by_name": _sql("SELECT * FROM by_name", *_SUMMARIES),
    "summary_view": _sql(
        """SELECT restaurant_name,
                  CASE WHEN food LIKE 'Mixed%' THEN 'No food summary available.' ELSE food END AS food,
                  service, ambiance
           FROM wide
           QUALIFY row_number() OVER (PARTITION BY restaurant_name ORDER BY business_id) = 1""",
        *_SUMMARIES,
    ),
    "summary_lookup": _sql(
        "SELECT * FROM by_name WHERE restaurant_name = (SELECT min(source) FROM documents)",
        *_SUMMARIES,
    ),
    "review_insights": _insights("drawn", _LANG),
    "review_insights_all": _insights("eligible", _LANG),
    "review_insights_repeated": _insights("eligible", _THIRDS),
}
