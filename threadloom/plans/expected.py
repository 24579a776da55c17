"""Expected results as SQL over the base tables, for engines that run ANSI SQL.

Written independently of the operators: where an operator takes minimum and
maximum, counts before joining or enumerates counted transactions, the SQL counts
distinct values, joins rows and enumerates every transaction.
"""

from __future__ import annotations

from collections.abc import Sequence

from threadloom import schemas
from threadloom.functions.text import FLAIR_SYMBOLS, WHITESPACE
from threadloom.operators.dependencies import DOMAIN_DEPENDENCIES
from threadloom.plans.layout import COLLECTION_QUERIES
from threadloom.plans.registry import LOW_CONFIDENCE, LOW_SUPPORT, SECOND_LOAD
from threadloom.plans.workspace import LOAD_TIME
from threadloom.sources.mapping import BASE_TABLES, COMMENTS_SQL

SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _order(columns: Sequence[str], lead: Sequence[str], last: bool) -> str:
    ordered = [*lead, *[c for c in columns if c not in lead]]
    suffix = "DESC NULLS FIRST" if last else "ASC NULLS LAST"
    return ", ".join(f"{c} {suffix}" for c in ordered)


def _pick(
    source: str, key: str, columns: Sequence[str], last: bool = False,
    lead: Sequence[str] = ("created_utc", "name"), extra: Sequence[str] = (),
) -> str:
    """First or last row per key."""
    return (
        f"SELECT {', '.join([*columns, *extra])} FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {_order(columns, lead, last)}) = 1"
    )


def _columns(table: str) -> list[str]:
    return schemas.RELATIONAL[table].names


def _blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}, {_quoted(WHITESPACE)}) = '')"


def _bad_time(column: str = "created_utc") -> str:
    return f"({column} IS NOT NULL AND ({column} < 1100000000 OR {column} > 1800000000))"


def _mentions(column: str = "body") -> str:
    return (
        f"({column} IN ('[deleted]', '[removed]') OR {column} ILIKE '%[deleted]%' "
        f"OR {column} ILIKE '%[removed]%')"
    )


def _comment_list(changes: dict[str, str]) -> str:
    return ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in _columns("comment"))


_DOC_COMMENT = schemas.DOCUMENTS["comments"].names
_DOC_POST = ["_id", "subreddit_id", "subreddit", "author", "archived", "gilded", "edited",
             "retrieved_on"]
_DOC_MODERATION = schemas.DOCUMENTS["moderation"].names
_EMBEDDED = schemas.EMBEDDED_COMMENT.names

_COMMENT_DROP = f"""CASE WHEN {_blank('link_id')} THEN 'dropped_missing_link_id'
    WHEN {_blank('body')} THEN 'dropped_missing_body'
    WHEN body IN ('[deleted]', '[removed]') THEN 'dropped_deleted_or_removed'
    WHEN {_bad_time()} THEN 'dropped_invalid_created_utc' END"""
_POST_DROP = f"""CASE WHEN {_blank('subreddit_id')} THEN 'dropped_missing_subreddit_id'
    WHEN {_bad_time()} THEN 'dropped_invalid_created_utc' END"""
_SYMBOL_FLAIR = (
    f"(author_flair_text <> '' AND trim(trim(author_flair_text, {_quoted(WHITESPACE)}), "
    f"{_quoted(FLAIR_SYMBOLS)}) = '')"
)
_WRONG_SCORE = "(score IS NOT NULL AND ups IS NOT NULL AND downs IS NOT NULL AND score <> ups - downs)"

_SCORE_BAND = """CASE WHEN score > 50 THEN 'very_high_score' WHEN score > 20 THEN 'high_score'
    WHEN score > 5 THEN 'medium_score' WHEN score > 0 THEN 'low_score'
    ELSE 'negative_score' END"""


def _flat() -> str:
    mapped = COMMENTS_SQL.format(**{t: t for t in BASE_TABLES})
    types = ", ".join(
        f"CAST({f.name} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in schemas.FLAT.fields
    )
    return f"SELECT {types} FROM ({mapped})"


# name -> (names it reads, statement)
def _ctes() -> dict[str, tuple[list[str], str]]:
    users, subreddit, post, post_link, comment = (
        _columns(t) for t in ("users", "subreddit", "post", "post_link", "comment")
    )
    linked = ", ".join(
        "CASE WHEN parent_id LIKE 't3\\_%' ESCAPE '\\' THEN NULL ELSE parent_id END AS parent_id"
        if c == "parent_id" else c for c in comment
    )
    post_flags = "COALESCE({0} <> 0, FALSE) AS {0}"
    embedded = ", ".join(_EMBEDDED)
    return {
        "flat": ([], _flat()),
        "users": (["flat"], _pick("(SELECT * FROM flat WHERE author IS NOT NULL)", "author", users)),
        "subreddit": (["flat"], _pick(
            "(SELECT * FROM flat WHERE subreddit_id IS NOT NULL)", "subreddit_id", subreddit)),
        "post": (["flat"], _pick(
            "(SELECT * FROM flat WHERE link_id IS NOT NULL AND subreddit_id IS NOT NULL)",
            "link_id", post)),
        "post_link": (["flat"], _pick(
            "(SELECT *, parent_id AS post_id FROM flat WHERE parent_id LIKE 't3\\_%' ESCAPE '\\')",
            "link_id", post_link)),
        "comment": (["flat", "post_link"], _pick(
            f"(SELECT name, {linked} FROM flat WHERE link_id IN (SELECT link_id FROM post_link))",
            "id", comment)),
        "moderation": (["flat"], f"""
            SELECT row_number() OVER (ORDER BY id ASC NULLS LAST, subreddit_id ASC NULLS LAST,
                       removal_reason ASC NULLS LAST, distinguished ASC NULLS LAST) AS mod_action_id,
                   CASE WHEN id LIKE 't3\\_%' ESCAPE '\\' THEN 'post' ELSE 'comment' END AS target_type,
                   id AS target_id, subreddit_id, removal_reason, distinguished,
                   CAST({LOAD_TIME} AS BIGINT) AS action_timestamp
            FROM flat WHERE subreddit_id IS NOT NULL"""),
        "users_cleaned": (["users"], f"""
            SELECT author, CASE WHEN {_SYMBOL_FLAIR} THEN NULL ELSE author_flair_text END
                       AS author_flair_text, author_flair_css_class
            FROM users WHERE NOT {_blank('author')}"""),
        "subreddit_cleaned": (["subreddit"],
            f"SELECT * FROM subreddit WHERE NOT {_blank('subreddit_id')}"),
        "post_cleaned": (["post"], f"""
            SELECT link_id, subreddit_id, author, created_utc, archived, gilded,
                   CASE WHEN edited < 0 THEN NULL ELSE edited END AS edited
            FROM post WHERE {_POST_DROP} IS NULL"""),
        "comment_cleaned": (["comment"], f"""
            SELECT {_comment_list({
                'author': f"CASE WHEN {_blank('author')} THEN NULL ELSE author END",
                'score': f"CASE WHEN {_WRONG_SCORE} THEN ups - downs ELSE score END",
            })} FROM comment WHERE {_COMMENT_DROP} IS NULL"""),
        "moderation_cleaned": (["moderation"], f"""
            SELECT * FROM moderation
            WHERE NOT {_blank('target_id')} AND NOT {_blank('subreddit_id')}"""),
        "doc_users": (["flat"], _pick(
            "(SELECT *, author AS _id FROM flat WHERE author <> '' AND author <> '[deleted]')",
            "_id", schemas.DOCUMENTS["users"].names, last=True)),
        "doc_subreddits": (["flat"], "SELECT _id, name_ AS name FROM (" + _pick(
            "(SELECT *, subreddit_id AS _id, subreddit AS name_ FROM flat WHERE subreddit_id <> '')",
            "_id", ["_id", "name_"], last=True) + ")"),
        "doc_comment_rows": (["flat"], _pick(
            f"""(SELECT * REPLACE ({post_flags.format('score_hidden')},
                 {post_flags.format('edited')}), link_id AS post_id
                 FROM flat WHERE id <> '' AND link_id <> '')""",
            "id", _DOC_COMMENT, extra=["name"])),
        "doc_comments": (["doc_comment_rows"],
            f"SELECT {', '.join(_DOC_COMMENT)} FROM doc_comment_rows"),
        "embedded": (["doc_comment_rows"], f"""
            SELECT post_id, {embedded}, row_number() OVER (PARTITION BY post_id ORDER BY
                   {_order(_EMBEDDED, ['created_utc', 'name'], False)}) - 1 AS position
            FROM doc_comment_rows"""),
        "doc_posts": (["flat", "embedded"], f"""
            SELECT p._id, subreddit_id, subreddit AS subreddit_name, author, created_utc, archived,
                   gilded, edited, retrieved_on, COALESCE(n, 0) AS comment_count,
                   COALESCE(least(n, 200), 0) AS embedded_count, COALESCE(ids, '') AS comment_ids
            FROM ({_pick(f'''(SELECT * REPLACE ({post_flags.format('archived')},
                 {post_flags.format('edited')}), link_id AS _id FROM flat WHERE link_id <> '')''',
                 '_id', _DOC_POST, extra=['created_utc'])}) p
            LEFT JOIN (SELECT post_id, count(*) AS n,
                       string_agg(id, ', ' ORDER BY position) FILTER (position < 200) AS ids
                       FROM embedded GROUP BY post_id) e ON p._id = e.post_id"""),
        "doc_moderation": (["flat"], _pick(
            """(SELECT *, concat(coalesce(id, 'None'), '_', coalesce(subreddit_id, 'None')) AS _id,
                'comment' AS target_type, id AS target_id, retrieved_on AS action_timestamp
                FROM flat WHERE removal_reason <> '' OR distinguished <> '')""",
            "_id", _DOC_MODERATION, last=True)),
        "mining_input": (["comment_cleaned", "post_cleaned", "subreddit_cleaned"], """
            SELECT s.subreddit, c.score, c.gilded, c.controversiality, c.edited, p.archived,
                   CAST(NULL AS VARCHAR) AS distinguished
            FROM comment_cleaned c JOIN post_cleaned p ON c.link_id = p.link_id
            JOIN subreddit_cleaned s ON p.subreddit_id = s.subreddit_id"""),
        "item_lists": (["mining_input"], f"""
            SELECT list_sort([x FOR x IN [
                CASE WHEN subreddit IS NOT NULL THEN concat('subreddit:', subreddit) END,
                {_SCORE_BAND},
                CASE WHEN gilded > 0 THEN 'gilded' END,
                CASE WHEN controversiality > 0 THEN 'controversial' END,
                CASE WHEN edited <> 0 THEN 'edited' END,
                CASE WHEN archived = 1 THEN 'archived' END] IF x IS NOT NULL]) AS items
            FROM mining_input"""),
        "subsets": (["item_lists"], """
            SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items,
                   count(*) AS freq
            FROM (SELECT items, unnest(range(1, CAST(1 << len(items) AS BIGINT))) AS mask
                  FROM item_lists) GROUP BY 1"""),
        "supports": (["subsets", "item_lists"], """
            SELECT items, freq, CAST(freq AS DOUBLE) / (SELECT count(*) FROM item_lists) AS support,
                   len(items) AS length FROM subsets"""),
    }


def _rules(min_support: float, min_confidence: float) -> str:
    """Statement for the rules at given thresholds; reads `supports`."""
    return f"""
    WITH frequent AS (SELECT * FROM supports WHERE support >= CAST({min_support} AS DOUBLE)),
    split AS (
      SELECT support, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS a,
             list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS c
      FROM (SELECT items, support, unnest(range(1, CAST((1 << length) - 1 AS BIGINT))) AS mask
            FROM frequent WHERE length > 1)
    ), scored AS (
      SELECT split.a, split.c, fa.support AS antecedent_support,
             fc.support AS consequent_support, split.support,
             split.support / fa.support AS confidence
      FROM split JOIN frequent fa ON fa.items = split.a JOIN frequent fc ON fc.items = split.c
    )
    SELECT array_to_string(a, ', ') AS antecedents, array_to_string(c, ', ') AS consequents,
           antecedent_support, consequent_support, support, confidence,
           confidence / consequent_support AS lift,
           CASE WHEN confidence < 1 THEN (1.0::DOUBLE - consequent_support) / (1.0::DOUBLE - confidence)
                ELSE 'infinity'::DOUBLE END AS conviction
    FROM scored WHERE confidence >= CAST({min_confidence} AS DOUBLE)"""


def _with(reads: Sequence[str], body: str) -> str:
    """Prefix a statement with everything it reads, in order."""
    ctes = _ctes()
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in ctes[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        visit(name)
    prefix = ",\n".join(f"{name} AS ({ctes[name][1]})" for name in ordered)
    # The body may open with its own WITH, so it becomes a subquery.
    return f"WITH {prefix}\nSELECT * FROM (\n{body}\n)"


def _anti_count(child: str, key: str, parent: str, parent_key: str, column: str,
                extra: str = "") -> str:
    return (
        f"SELECT count(*) AS {column} FROM {child} c LEFT JOIN {parent} p "
        f"ON c.{key} = p.{parent_key} WHERE p.{parent_key} IS NULL{extra}"
    )


_REFERENCES = {
    "missing_user_refs": ("post", "author", "users", "author", " AND c.author IS NOT NULL"),
    "missing_subreddit_refs": ("post", "subreddit_id", "subreddit", "subreddit_id", ""),
    "invalid_post_links": ("post_link", "post_id", "post", "link_id", ""),
    "invalid_comment_links": ("comment", "link_id", "post_link", "link_id", ""),
    "invalid_parent_comments": ("comment", "parent_id", "comment", "id",
                                " AND c.parent_id IS NOT NULL"),
    "invalid_moderation_subs": ("moderation", "subreddit_id", "subreddit", "subreddit_id", ""),
}
_SUMMARY_NAMES = ["orphan_posts_by_user", "orphan_posts_by_subreddit", "orphan_postlinks",
                  "orphan_comments", "orphan_comment_parents", "orphan_moderations"]


def _check_sql() -> dict[str, tuple[list[str], str]]:
    sql: dict[str, tuple[list[str], str]] = {}
    for table in schemas.RELATIONAL:
        column = "user_count" if table == "users" else f"{table}_count"
        sql[f"chk_count_{table}"] = ([table], f"SELECT count(*) AS {column} FROM {table}")
    for column, (child, key, parent, parent_key, extra) in _REFERENCES.items():
        name = "invalid_parents" if column == "invalid_parent_comments" else column
        sql[f"chk_{name}"] = (
            [child, parent], _anti_count(child, key, parent, parent_key, column, extra))
    sql["chk_invalid_parents_prefixed"] = (["comment"], """
        SELECT count(*) AS invalid_parent_comments FROM comment c
        LEFT JOIN comment p ON c.parent_id = concat('t1_', p.id)
        WHERE c.parent_id IS NOT NULL AND p.id IS NULL""")
    parts = [
        f"({_anti_count(c, k, p, pk, 'n', x)}) AS {name}"
        for name, (c, k, p, pk, x) in zip(_SUMMARY_NAMES, _REFERENCES.values())
    ]
    sql["chk_orphan_summary"] = (list(schemas.RELATIONAL), f"SELECT {', '.join(parts)}")
    sql["chk_post_join"] = (["post", "users", "subreddit"], """
        SELECT p.link_id, u.author, s.subreddit, p.created_utc FROM post p
        JOIN users u ON p.author = u.author JOIN subreddit s ON p.subreddit_id = s.subreddit_id
        ORDER BY p.link_id LIMIT 10""")
    sql["chk_comment_join"] = (["comment", "post_link", "post", "users"], """
        SELECT c.id, c.body, p.link_id AS post_link, u.author FROM comment c
        JOIN post_link pl ON c.link_id = pl.link_id JOIN post p ON pl.post_id = p.link_id
        LEFT JOIN users u ON c.author = u.author ORDER BY c.id LIMIT 10""")
    sql["chk_moderation_join"] = (["moderation", "subreddit"], """
        SELECT m.mod_action_id, m.target_type, m.target_id, s.subreddit, m.removal_reason
        FROM moderation m JOIN subreddit s ON m.subreddit_id = s.subreddit_id
        ORDER BY m.mod_action_id LIMIT 10""")
    sql["chk_posts_per_subreddit"] = (["post"], """
        SELECT subreddit_id, count(*) AS posts FROM post GROUP BY subreddit_id
        ORDER BY posts DESC, subreddit_id LIMIT 10""")
    sql["chk_comments_per_post"] = (["comment"], """
        SELECT link_id, count(*) AS comment_count FROM comment GROUP BY link_id
        ORDER BY comment_count DESC, link_id LIMIT 10""")
    return sql


def _timed(text: str) -> str:
    return f"CAST(epoch(TIMESTAMP '{text}') AS BIGINT)"


def _analytics_sql() -> dict[str, tuple[list[str], str]]:
    between = "p.created_utc BETWEEN {} AND {}"
    return {
        "q1_latest_posts": (["post", "subreddit"], f"""
            SELECT p.link_id, p.author, s.subreddit, p.created_utc FROM post p
            JOIN subreddit s ON p.subreddit_id = s.subreddit_id
            WHERE s.subreddit = 'AskReddit' AND
            {between.format(_timed('2015-05-28 00:00:00'), _timed('2015-05-29 00:00:00'))}
            ORDER BY p.created_utc DESC, p.link_id LIMIT 50"""),
        "q2_busy_posts": (["post", "comment", "subreddit"], f"""
            SELECT p.link_id, s.subreddit, count(c.id) AS comment_count FROM post p
            JOIN comment c ON p.link_id = c.link_id
            JOIN subreddit s ON p.subreddit_id = s.subreddit_id
            WHERE {between.format(_timed('2015-05-25 00:00:00'), _timed('2015-05-29 23:59:59'))}
            GROUP BY p.link_id, s.subreddit HAVING count(c.id) > 5
            ORDER BY comment_count DESC, p.link_id LIMIT 10"""),
        "q3_top_authors": (["post"], """
            SELECT author, count(link_id) AS total_posts FROM post WHERE author IS NOT NULL
            GROUP BY author ORDER BY total_posts DESC, author LIMIT 20"""),
        "q4_gilded_live": (["post", "subreddit"], f"""
            SELECT p.link_id, p.author, s.subreddit, p.gilded, p.archived FROM post p
            JOIN subreddit s ON p.subreddit_id = s.subreddit_id
            WHERE p.gilded > 0 AND p.archived = 0 AND
            {between.format(_timed('2015-05-27 00:00:00'), _timed('2015-05-27 23:59:59'))}
            ORDER BY p.created_utc DESC, p.link_id LIMIT 30"""),
        "q5_author_like": (["post", "subreddit"], """
            SELECT p.link_id, p.author, s.subreddit, p.created_utc FROM post p
            JOIN subreddit s ON p.subreddit_id = s.subreddit_id WHERE p.author LIKE '%cat%'
            ORDER BY p.created_utc DESC, p.link_id LIMIT 20"""),
        "q6_avg_comments": (["post", "comment", "subreddit"], """
            SELECT s.subreddit, CAST((200 * sum(n) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0::DOUBLE
                   AS avg_comments_per_post
            FROM (SELECT p.subreddit_id, p.link_id, count(c.id) AS n FROM post p
                  LEFT JOIN comment c ON p.link_id = c.link_id
                  GROUP BY p.subreddit_id, p.link_id) x
            JOIN subreddit s ON s.subreddit_id = x.subreddit_id
            GROUP BY s.subreddit ORDER BY avg_comments_per_post DESC, s.subreddit LIMIT 10"""),
    }


_COLLECTIONS = {
    "users": "doc_users", "subreddits": "doc_subreddits", "posts": "doc_posts",
    "comments": "doc_comments", "moderation": "doc_moderation",
}


def _document_sql() -> dict[str, tuple[list[str], str]]:
    embedded = ", ".join(_EMBEDDED)
    counts = (list(_COLLECTIONS.values()), " UNION ALL ".join(
        f"SELECT '{n}' AS collection, count(*) AS documents FROM {t}"
        for n, t in _COLLECTIONS.items()))
    posts = (["doc_posts"], "SELECT * FROM doc_posts")
    by_comment = """(SELECT c.post_id AS _id, m.removal_reason, m.distinguished
                     FROM doc_moderation m JOIN doc_comments c ON m.target_id = c.id)"""
    as_stored = "(SELECT target_id AS _id, removal_reason, distinguished FROM doc_moderation)"

    def moderated(records: str) -> str:
        return f"""
            SELECT p._id, p.subreddit_name, p.author, m.removal_reason, m.distinguished
            FROM (SELECT * FROM doc_posts WHERE _id IN (SELECT _id FROM {records})
                  ORDER BY _id LIMIT 3) p JOIN {records} m ON m._id = p._id"""

    def moderated_count(records: str) -> str:
        return f"""SELECT count(*) AS posts_with_moderation FROM doc_posts
                   WHERE _id IN (SELECT _id FROM {records})"""

    no_flair = """SELECT * FROM doc_users WHERE coalesce(author_flair_text, '') = ''
                  AND coalesce(author_flair_css_class, '') = '' ORDER BY _id LIMIT 3"""
    no_subreddit = """SELECT _id, subreddit_id, subreddit_name, author, comment_count FROM doc_posts
                      WHERE coalesce(subreddit_id, '') = '' ORDER BY _id LIMIT 3"""
    within = "FROM embedded WHERE position < 200"
    common = ["_id", "id", "post_id", "name", "author", "subreddit_id", "created_utc", "comment_ids",
              "comment_count", "embedded_count", "removal_reason", "distinguished",
              "action_timestamp", "retrieved_on"]
    present = {
        "users": ["_id"], "subreddits": ["_id", "name"],
        "posts": ["_id", "author", "subreddit_id", "created_utc", "comment_ids", "comment_count",
                  "embedded_count", "retrieved_on"],
        "comments": ["id", "post_id", "author", "created_utc", "distinguished", "retrieved_on"],
        "moderation": ["_id", "subreddit_id", "removal_reason", "distinguished",
                       "action_timestamp"],
    }
    everything = ([f"doc_{name}" for name in present], " UNION ALL ".join(
        f"SELECT '{name}' AS collection, " + ", ".join(
            f"CAST({c if c in columns else 'NULL'} AS VARCHAR) AS {c}" for c in common)
        + f" FROM doc_{name}" for name, columns in present.items()))
    return {
        "doc_bool": (["flat"], """
            SELECT coalesce(score_hidden <> 0, FALSE) AS score_hidden,
                   coalesce(archived <> 0, FALSE) AS archived, coalesce(edited <> 0, FALSE) AS edited,
                   coalesce(gilded <> 0, FALSE) AS gilded,
                   coalesce(distinguished <> '', FALSE) AS distinguished, count(*) AS row_count
            FROM flat GROUP BY ALL"""),
        "doc_users": (["doc_users"], "SELECT * FROM doc_users"),
        "doc_subreddits": (["doc_subreddits"], "SELECT * FROM doc_subreddits"),
        "doc_posts": posts,
        "doc_comments": (["doc_comments"], "SELECT * FROM doc_comments"),
        "doc_embed": (["embedded"], f"SELECT post_id, position, {embedded} {within}"),
        "doc_embed_cap_2": (["embedded"],
            f"SELECT post_id, position, {embedded} FROM embedded WHERE position < 2"),
        "doc_embed_off": (["doc_posts"], """
            SELECT * REPLACE (CAST(0 AS BIGINT) AS embedded_count, '' AS comment_ids)
            FROM doc_posts"""),
        "doc_counters": (["doc_posts"], "SELECT _id, comment_count, embedded_count FROM doc_posts"),
        "doc_moderation": (["doc_moderation"], "SELECT * FROM doc_moderation"),
        "doc_counts": counts,
        "doc_layout": (["post", "comment"], """
            SELECT link_id, subreddit_id, author, created_utc, archived, gilded, edited FROM post
            UNION ALL SELECT link_id, NULL, author, created_utc, NULL, gilded, edited FROM comment"""),
        "stream_doc_load": posts,
        "stream_doc_counts": counts,
        "stream_doc_comments": (["doc_comments"], "SELECT * FROM doc_comments"),
        "stream_doc_compact": everything,
        "stream_doc_two_sources": everything,
        "stream_doc_empty": (["flat"], " UNION ALL ".join(
            f"SELECT '{n}' AS collection, CAST(0 AS BIGINT) AS documents" for n in _COLLECTIONS)),
        "doc_layout_collections": everything,
        "doc_layout_z_order": everything,
        "rel_users": (["doc_users"], """
            SELECT _id AS author, author_flair_text, author_flair_css_class FROM doc_users"""),
        "rel_subreddit": (["doc_subreddits"],
            "SELECT _id AS subreddit_id, name AS subreddit FROM doc_subreddits"),
        "rel_subreddit_from_posts": (["doc_subreddits", "doc_posts"], f"""
            WITH found AS ({_pick(
                '''(SELECT subreddit_id, subreddit_name AS subreddit, created_utc, _id
                    FROM doc_posts WHERE subreddit_id IS NOT NULL)''',
                'subreddit_id', ['subreddit_id', 'subreddit'], last=True,
                lead=['created_utc', '_id'])})
            SELECT * FROM found UNION ALL
            SELECT _id, name FROM doc_subreddits
            WHERE _id NOT IN (SELECT subreddit_id FROM found)"""),
        "rel_post": (["doc_posts"], """
            SELECT _id AS link_id, subreddit_id, nullif(author, '[deleted]') AS author, created_utc,
                   CAST(archived AS INTEGER) AS archived, gilded, CAST(edited AS BIGINT) AS edited
            FROM doc_posts"""),
        "rel_post_link": (["doc_posts"], """
            SELECT _id AS link_id, _id AS post_id, retrieved_on FROM doc_posts
            WHERE retrieved_on IS NOT NULL"""),
        "rel_comment": (["doc_comments"], f"""
            SELECT {_comment_list({
                'author': "nullif(author, '[deleted]')", 'link_id': 'post_id',
                'score_hidden': 'CAST(score_hidden AS INTEGER)', 'edited': 'CAST(edited AS BIGINT)',
            })} FROM doc_comments"""),
        "rel_moderation": (["doc_moderation"], """
            SELECT row_number() OVER (ORDER BY target_id ASC NULLS LAST, subreddit_id ASC NULLS LAST,
                       target_type ASC NULLS LAST, removal_reason ASC NULLS LAST,
                       distinguished ASC NULLS LAST, action_timestamp ASC NULLS LAST) AS mod_action_id,
                   target_type, target_id, subreddit_id, removal_reason, distinguished,
                   action_timestamp FROM doc_moderation"""),
        "rel_moderation_dedupe": (["doc_moderation"], """
            SELECT DISTINCT target_type, target_id, subreddit_id, removal_reason, distinguished,
                   action_timestamp FROM doc_moderation"""),
        "docq_counts": counts,
        "docq_sample_user": (["doc_users"], "SELECT * FROM doc_users ORDER BY _id LIMIT 1"),
        "docq_sample_subreddit": (["doc_subreddits"],
            "SELECT * FROM doc_subreddits ORDER BY _id LIMIT 1"),
        "docq_sample_moderation": (["doc_moderation"],
            "SELECT * FROM doc_moderation ORDER BY _id LIMIT 1"),
        "docq_post_slice": (["doc_posts"], """
            SELECT * REPLACE (split_part(comment_ids, ', ', 1) AS comment_ids)
            FROM doc_posts ORDER BY _id LIMIT 1"""),
        "docq_null_flair": (["doc_users"], no_flair),
        "docq_null_flair_count": (["doc_users"], f"SELECT count(*) AS user_count FROM ({no_flair})"),
        "docq_dup_subreddits": (["doc_subreddits"], """
            SELECT name, count(*) AS name_count FROM doc_subreddits GROUP BY name
            HAVING count(*) > 1 ORDER BY name NULLS FIRST LIMIT 5"""),
        "docq_posts_with_comments": (["doc_posts"],
            "SELECT count(*) AS post_count FROM doc_posts WHERE embedded_count > 0"),
        "docq_avg_comments": (["doc_posts"],
            "SELECT avg(embedded_count) AS avg_comments FROM doc_posts"),
        "docq_posts_no_author": (["doc_posts"],
            "SELECT count(*) AS post_count FROM doc_posts WHERE coalesce(author, '') = ''"),
        "docq_posts_per_subreddit": (["doc_posts"], """
            SELECT subreddit_name AS name, count(*) AS post_count FROM doc_posts GROUP BY 1
            ORDER BY post_count DESC, name NULLS FIRST LIMIT 10"""),
        "docq_total_embedded": (["embedded"], f"SELECT count(*) AS total_comments {within}"),
        "docq_dup_subreddits_posts": (["doc_posts"], """
            SELECT subreddit_name AS name, count(*) AS name_count
            FROM (SELECT DISTINCT subreddit_id, subreddit_name FROM doc_posts)
            GROUP BY subreddit_name HAVING count(*) > 1
            ORDER BY subreddit_name ASC NULLS FIRST LIMIT 5"""),
        "docq_random_comments_found": (["embedded"], f"""
            SELECT least(2, count(*)) AS drawn, least(2, count(*)) AS embedded {within}"""),
        "docq_controversial": (["embedded"], f"""
            SELECT post_id, id, controversiality {within} AND controversiality > 0
            ORDER BY id LIMIT 3"""),
        "docq_removals": (["doc_moderation"], """
            SELECT count(*) AS action_count FROM doc_moderation WHERE removal_reason IS NOT NULL"""),
        "docq_top_moderated": (["doc_moderation"], """
            SELECT subreddit_id, count(*) AS actions FROM doc_moderation GROUP BY subreddit_id
            ORDER BY actions DESC, subreddit_id NULLS FIRST LIMIT 10"""),
        "docq_posts_moderated_count": (["doc_posts", "doc_moderation"], moderated_count(as_stored)),
        "docq_posts_moderated": (["doc_posts", "doc_moderation"], moderated(as_stored)),
        "docq_posts_moderated_count_by_comment": (
            ["doc_posts", "doc_moderation", "doc_comments"], moderated_count(by_comment)),
        "docq_posts_moderated_by_comment": (
            ["doc_posts", "doc_moderation", "doc_comments"], moderated(by_comment)),
        "docq_missing_subreddit": (["doc_posts"], no_subreddit),
        "docq_missing_subreddit_count": (["doc_posts"],
            f"SELECT count(*) AS post_count FROM ({no_subreddit})"),
        "docq_empty_bodies": (["embedded"], f"""
            SELECT post_id, id, author, body {within} AND coalesce(body, '') = ''
            ORDER BY id LIMIT 3"""),
    }


def _normalization_sql() -> dict[str, tuple[list[str], str]]:
    sql: dict[str, tuple[list[str], str]] = {
        f"norm_{t}": ([t], f"SELECT * FROM {t}") for t in schemas.RELATIONAL
    }
    sql["norm_target_type"] = (["flat"], """
        SELECT CASE WHEN starts_with(target_id, 't3_') THEN 'post' ELSE 'comment' END AS target_type,
               count(*) AS targets
        FROM (SELECT id AS target_id FROM flat UNION ALL SELECT name FROM flat
              UNION ALL SELECT link_id FROM flat) GROUP BY 1""")
    sql["norm_moderation_stats"] = (["moderation"], """
        SELECT count(*) FILTER (target_type = 'post') AS post_count,
               count(*) FILTER (target_type = 'comment') AS comment_count,
               count(*) FILTER (target_type IS NULL) AS null_count FROM moderation""")
    rejects = {
        ("users", "author not null"): "FROM flat WHERE author IS NULL",
        ("subreddit", "subreddit_id not null"): "FROM flat WHERE subreddit_id IS NULL",
        ("post", "subreddit_id not null"): "FROM flat WHERE subreddit_id IS NULL",
        ("post_link", "post_id references post"):
            "FROM flat WHERE starts_with(parent_id, 't3_') "
            "AND parent_id NOT IN (SELECT link_id FROM post)",
        ("comment", "link_id references post"):
            "FROM flat WHERE link_id NOT IN (SELECT link_id FROM post)",
        ("comment", "author references users"):
            "FROM flat WHERE author IS NOT NULL AND author NOT IN (SELECT author FROM users)",
    }
    sql["norm_constraints"] = (["flat", "post", "users"], "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS constraint_name, count(*) AS rejected {body}"
        for (t, c), body in rejects.items()) + ") WHERE rejected > 0")
    sql["norm_defaults"] = (["post"], """
        SELECT 'given' AS source, link_id, coalesce(gilded, 0) AS gilded FROM post
        UNION ALL SELECT 'absent', link_id, 0 FROM post""")
    sql["norm_defaults_comment"] = (["comment"], """
        SELECT 'given' AS source, id, coalesce(gilded, 0) AS gilded FROM comment
        UNION ALL SELECT 'absent', id, 0 FROM comment""")
    sql["norm_defaults_moderation"] = (["moderation"], f"""
        SELECT 'given' AS source, mod_action_id, CASE WHEN mod_action_id % 2 = 0
            THEN coalesce(action_timestamp, {LOAD_TIME}) ELSE {LOAD_TIME} END AS action_timestamp
        FROM moderation UNION ALL SELECT 'absent', mod_action_id, {LOAD_TIME} FROM moderation""")
    left = "SELECT author FROM users WHERE NOT starts_with(author, 'cat_')"
    sql["norm_set_null"] = (["post", "comment", "users"], " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, {key} AS id,
            CASE WHEN author IN ({left}) THEN author END AS author FROM {t}"""
        for t, key in (("post", "link_id"), ("comment", "id"))))
    filters = {
        "post_link": " WHERE starts_with(parent_id, 't3_')",
        "comment": " WHERE link_id IN (SELECT link_id FROM post_link)",
    }
    sql["norm_load_stats"] = (["flat", *schemas.RELATIONAL], " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM flat) AS rows_read,
            (SELECT count(*) FROM flat{filters.get(t, '')}) AS rows_filtered,
            (SELECT count(*) FROM {t}) AS rows_inserted""" for t in schemas.RELATIONAL))
    return sql


def _source_sql() -> dict[str, tuple[list[str], str]]:
    tables = {"comments_raw": ("flat", schemas.FLAT),
              **{t: (t, s) for t, s in schemas.RELATIONAL.items()}}
    catalog = [
        f"SELECT '{name}' AS table_name, {i} AS position, '{f.name}' AS column_name, "
        f"'{f.dataType.simpleString()}' AS column_type, "
        f"{f.name in schemas.PRIMARY_KEYS.get(name, [])} AS is_key, "
        f"count({f.name}) AS present_values FROM {source}"
        for name, (source, schema) in tables.items()
        for i, f in enumerate(schema.fields, 1)
    ]
    sample = ["id", "link_id", "author", "created_utc", "name", "score", "body"]
    return {
        "src_flat": (["flat"],
            "SELECT id, link_id, subreddit, author, created_utc, score FROM flat"),
        "src_flat_chunks": (["flat"], f"SELECT {', '.join(schemas.DOCUMENT_COLUMNS)} FROM flat"),
        "src_table_stream": (["comment"], "SELECT * FROM comment"),
        "src_joined_mining": (["mining_input"], "SELECT * FROM mining_input"),
        "src_docs": (["doc_posts"], "SELECT * FROM doc_posts"),
        "src_json": (["flat"], "SELECT * FROM flat"),
        "src_json_kept": (["flat"], "SELECT * FROM flat WHERE coalesce(created_utc % 7, 2) > 1"),
        "src_json_rejected": (["flat"], """SELECT coalesce(id, '') AS id, created_utc % 7 = 1 AS is_whole
            FROM flat WHERE created_utc % 7 <= 1"""),
        "src_catalog": (["flat", *schemas.RELATIONAL], " UNION ALL ".join(catalog)),
        "src_session_catalog": (["flat", *schemas.RELATIONAL], " UNION ALL ".join(catalog)),
        "src_sample": (["flat"], f"""SELECT {', '.join(sample)} FROM flat
            ORDER BY {_order(sample, ['created_utc', 'name'], False)} LIMIT 1000"""),
    }


def _sink_sql() -> dict[str, tuple[list[str], str]]:
    post_link = """
        SELECT coalesce(o.link_id, n._id) AS link_id, coalesce(o.post_id, n._id) AS post_id,
               CASE WHEN n._id IS NOT NULL THEN n.retrieved_on ELSE o.retrieved_on END AS retrieved_on
        FROM post_link o FULL JOIN (SELECT * FROM doc_posts WHERE retrieved_on IS NOT NULL) n
        ON o.link_id = n._id"""
    analytics = _analytics_sql()
    query_rows = " UNION ALL ".join(
        f"SELECT '{name}' AS query, (SELECT count(*) FROM ({sql})) AS row_count"
        for name, (_, sql) in analytics.items())
    users = _columns("users")
    return {
        "sink_insert_ignore": (["flat"], f"""
            WITH stored AS ({_pick(
                f"(SELECT * FROM flat WHERE author IS NOT NULL AND created_utc < {SECOND_LOAD})",
                'author', users)})
            SELECT * FROM stored UNION ALL SELECT * FROM ({_pick(
                '(SELECT * FROM flat WHERE author NOT IN (SELECT author FROM stored))',
                'author', users)})"""),
        "sink_upsert_docs": (["doc_users"], "SELECT * FROM doc_users"),
        "sink_upsert_rows": (["post_link", "doc_posts"], post_link),
        "sink_upsert_tables": (list(_COLLECTIONS.values()), """
            SELECT 'users' AS table_name, count(*) AS total_rows FROM doc_users
            UNION ALL SELECT 'subreddit', count(DISTINCT id) FROM (SELECT _id AS id FROM doc_subreddits
                UNION ALL SELECT subreddit_id FROM doc_posts)
            UNION ALL SELECT 'post', count(*) FROM doc_posts
            UNION ALL SELECT 'post_link', count(*) FROM doc_posts
            UNION ALL SELECT 'comment', count(*) FROM doc_comments
            UNION ALL SELECT 'moderation', 2 * count(*) FROM doc_moderation"""),
        "sink_append": (["doc_moderation"], " UNION ALL ".join([
            """SELECT target_type, target_id, subreddit_id, removal_reason, distinguished,
               action_timestamp FROM doc_moderation"""] * 2)),
        "sink_recreate": ([f"{t}_cleaned" for t in schemas.CLEANED_TABLES], " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}_cleaned"
            for t in schemas.CLEANED_TABLES)),
        "sink_reset": (list(_COLLECTIONS.values()), " UNION ALL ".join(
            f"""SELECT '{n}' AS collection, count(*) AS documents_before,
                CAST(0 AS BIGINT) AS documents_after FROM {t}"""
            for n, t in _COLLECTIONS.items())),
        "sink_csv": (["post", "comment", "subreddit"],
            f"SELECT query, row_count, TRUE AS has_speedup FROM ({query_rows})"),
        "q5_author_like_indexed": analytics["q5_author_like"],
        "bench_layout_joins": (["post", "comment", "subreddit"], f"""SELECT query,
            row_count AS rows_plain, row_count AS rows_clustered, row_count AS rows_bucketed
            FROM ({query_rows})"""),
        "bench_layout": (["post", "comment", "subreddit"],
            f"SELECT query, row_count AS rows_before, row_count AS rows_after FROM ({query_rows})"),
        "sink_fd_report": (["flat", *schemas.RELATIONAL], _fd_report_sql()),
        "sink_rule_report": (["supports"], _rule_report_sql()),
    }


def _lines(selects: Sequence[str]) -> str:
    return ("SELECT line, count(*) AS line_count FROM (" + " UNION ALL ".join(selects)
            + ") WHERE line IS NOT NULL GROUP BY line")


def _fd_report_sql() -> str:
    """The lines of the report in their order; 100 line numbers are left for each dependency."""
    tables = _tables()
    facts = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{', '.join(c)}' AS columns, count(*) AS row_count,
            {_quoted(', '.join(schemas.PRIMARY_KEYS[t])) if t in schemas.PRIMARY_KEYS else 'NULL'}
            AS primary_key FROM {s}""" for t, (s, c) in tables.items())
    # Only the first two groups of each failing dependency are shown.
    shown = " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{t}' AS table_name, *, row_number() OVER
            (ORDER BY determinant_value) AS n FROM ({_example_sql(x, [y], s)})) WHERE n <= 2"""
        for t, (s, c) in tables.items() for x, y, _ in DOMAIN_DEPENDENCIES if x in c and y in c)

    def of_table(number: int, line: str) -> str:
        return f"SELECT 2, entry, {number}, {line} FROM t"

    def of_fd(number: int, line: str) -> str:
        return f"SELECT 2, entry, 100 * place + {number}, {line} FROM d"

    lines = [
        "SELECT 1 AS section, 1 AS entry, 1 AS line_no, "
        "concat('- **Total Tables Analyzed**: ', count(*)) AS line FROM facts",
        "SELECT 1, 1, 2, concat('- **Total Functional Dependencies Discovered**: ', count(*)) FROM fd",
        of_table(1, "concat('### Table: `', table_name, '`')"),
        of_table(2, "concat('**Columns**: ', columns)"),
        of_table(3, "concat('**Row Count**: ', format('{:,}', row_count))"),
        of_table(4, "'**Primary Key**: `' || primary_key || '`'"),
        of_table(5, """CASE WHEN table_name IN (SELECT table_name FROM fd)
            THEN '#### Functional Dependencies' ELSE
            '*No functional dependencies discovered beyond primary key constraints.*' END"""),
        of_fd(1, "CASE WHEN of_type = 1 THEN concat('**', fd_type, ' Dependencies:**') END"),
        of_fd(2, """concat('- `', determinant, '` -> `', dependent, '` **',
            CASE WHEN holds THEN 'HOLDS' ELSE 'FAILS' END, '**')"""),
        of_fd(3, "concat('  - Type: ', fd_type)"),
        of_fd(4, "'  - Confidence: High'"),
        of_fd(5, "'  - Description: ' || description"),
        of_fd(6, """CASE WHEN NOT holds THEN concat('  - Violations: ', violations,
            ' violations in ', total_groups, ' groups') END"""),
        of_fd(7, """CASE WHEN NOT holds AND (table_name, determinant, dependent) IN
            (SELECT (table_name, determinant, dependent_column) FROM shown)
            THEN '  - Example violations:' END"""),
        """SELECT 2, entry, 100 * place + 7 + n, concat('    - ', determinant, '=',
            determinant_value, ' -> ', dependent_column, '=[', dependent_values, ']')
            FROM shown JOIN (SELECT table_name, determinant, dependent AS dependent_column, entry,
            place FROM d) USING (table_name, determinant, dependent_column)""",
    ]
    order = "list_position(['Primary Key', 'Candidate Key', 'Domain-Based'], fd_type)"
    return f"""WITH fd AS ({_primary_sql()} UNION ALL {_candidate_deps()}
        UNION ALL {_domain_all()}),
        facts AS (SELECT * FROM ({facts}) WHERE row_count > 0), shown AS ({shown}),
        t AS (SELECT *, row_number() OVER (ORDER BY table_name) AS entry FROM facts),
        d AS (SELECT fd.*, entry,
            row_number() OVER (PARTITION BY table_name ORDER BY {order}, determinant, dependent)
            AS place,
            row_number() OVER (PARTITION BY table_name, fd_type ORDER BY determinant, dependent)
            AS of_type FROM fd JOIN t USING (table_name)),
        lines AS ({" UNION ALL ".join(lines)})
        SELECT CAST(row_number() OVER (ORDER BY section, entry, line_no) AS INTEGER) AS position,
        line FROM lines WHERE line IS NOT NULL"""


def _rule_report_sql() -> str:
    rank = """row_number() OVER (ORDER BY confidence DESC, lift DESC, antecedents, consequents)"""
    numbered_sets = f"""SELECT array_to_string(items, ', ') AS items, support, length,
        row_number() OVER (ORDER BY support DESC, array_to_string(items, ', ')) AS entry
        FROM supports WHERE support >= CAST({LOW_SUPPORT} AS DOUBLE)"""
    return f"""WITH rules AS ({_rules(LOW_SUPPORT, LOW_CONFIDENCE)}),
        ranked AS (SELECT *, {rank} AS entry FROM rules),
        sets AS ({numbered_sets}), first_sets AS (SELECT * FROM sets WHERE entry <= 50)
        """ + _lines([
        "SELECT concat('Frequent Itemsets: ', count(*)) AS line FROM sets",
        "SELECT concat('Association Rules: ', count(*)) FROM rules",
        "SELECT printf('Average Confidence: %.4f', avg(confidence)) FROM rules",
        "SELECT printf('Average Lift: %.4f', avg(lift)) FROM rules",
        "SELECT concat('Rules with Lift > 1.0: ', count(*) FILTER (lift > 1)) FROM rules",
        "SELECT concat(entry, '. ', items) FROM first_sets",
        "SELECT printf('   Support: %.4f (%.2f%%)', support, support * 100) FROM first_sets",
        "SELECT concat('   Length: ', length, ' items') FROM first_sets",
        "SELECT concat('Rule ', entry, ':') FROM ranked",
        "SELECT concat('  IF ', antecedents) FROM ranked",
        "SELECT concat('  THEN ', consequents) FROM ranked",
        "SELECT printf('  Support: %.4f (%.2f%%)', support, support * 100) FROM ranked",
        "SELECT printf('  Confidence: %.4f (%.1f%%)', confidence, confidence * 100) FROM ranked",
        """SELECT concat(printf('  Lift: %.4f', lift), CASE WHEN lift > 1
           THEN ' (positive association)' WHEN lift < 1 THEN ' (negative association)'
           ELSE ' (no association)' END) FROM ranked""",
        """SELECT concat('  Conviction: ', CASE WHEN isinf(conviction) THEN 'inf'
           ELSE printf('%.4f', conviction) END) FROM ranked""",
    ])


def _dirty_sql() -> dict[str, tuple[list[str], str]]:
    def where(table: str, condition: str) -> tuple[list[str], str]:
        return [table], f"SELECT * FROM {table} WHERE {condition}"

    def absent(child: str, key: str, parent: str, parent_key: str, extra: str = ""):
        return [child, parent], f"""SELECT c.* FROM {child} c LEFT JOIN {parent} p
            ON c.{key} = p.{parent_key} WHERE p.{parent_key} IS NULL{extra}"""

    def repeated(table: str, key: str):
        return [table], (f"SELECT {key}, count(*) AS row_count FROM {table} GROUP BY {key} "
                         "HAVING count(*) > 1")

    withdrawn = where("comment", _mentions())
    return {
        "dirty_1_1": where("comment", "author IS NULL OR author = ''"),
        "dirty_1_2": where("post", "subreddit_id IS NULL OR subreddit_id = ''"),
        "dirty_1_3": where("comment", "body IS NULL OR body = ''"),
        "dirty_2_1": where("comment", "created_utc <= 0"),
        "dirty_2_2": where("comment", "created_utc < 1100000000 OR created_utc > 1800000000"),
        "dirty_3_1": absent("comment", "link_id", "post", "link_id"),
        "dirty_3_2": absent("post", "subreddit_id", "subreddit", "subreddit_id"),
        "dirty_3_3": absent("comment", "author", "users", "author", " AND c.author IS NOT NULL"),
        "dirty_4_1": repeated("post", "link_id"),
        "dirty_4_2": repeated("comment", "id"),
        "dirty_4_3": repeated("users", "author"),
        "dirty_5_1": (["comment"], """SELECT id, score, ups, downs FROM comment
            WHERE score IS DISTINCT FROM (ups - downs)"""),
        "dirty_5_2": where("comment", "edited IS NOT NULL AND edited < 0"),
        "dirty_5_3": where("post", "archived = 1 AND edited > 0"),
        "dirty_6_1": where("users", """(author_flair_text IS NOT NULL
            OR author_flair_css_class IS NOT NULL) AND author IS NULL"""),
        "dirty_6_2": where("users", "regexp_matches(author_flair_text, '^[!@#$%^&*]')"),
        "dirty_7_1": absent("comment", "parent_id", "comment", "id",
                            " AND c.parent_id LIKE 't1_%'"),
        "dirty_7_1_prefixed": (["comment"], """SELECT c.* FROM comment c
            LEFT JOIN comment p ON c.parent_id = concat('t1_', p.id)
            WHERE c.parent_id LIKE 't1_%' AND p.id IS NULL"""),
        "dirty_7_2": absent("comment", "parent_id", "post", "link_id",
                            " AND c.parent_id LIKE 't3_%'"),
        "dirty_8_1": withdrawn,
        "dirty_8_2": withdrawn,
        **_dirty_twins(),
    }


def _dirty_twins() -> dict[str, tuple[list[str], str]]:
    """The finders over raw rows, converted documents and a shortened list of communities."""
    comments = """(SELECT id, post_id AS link_id, parent_id, nullif(author, '[deleted]') AS author
        FROM doc_comments)"""
    kept = "id, link_id, parent_id, author"
    twice = f"""(SELECT id FROM flat UNION ALL
        SELECT id FROM flat WHERE created_utc < {SECOND_LOAD})"""

    def repeated(source: str, key: str) -> tuple[list[str], str]:
        return ["flat"], f"""SELECT {key}, count(*) AS row_count FROM {source} GROUP BY {key}
            HAVING count(*) > 1"""

    return {
        "dirty_3_1_converted": (["doc_comments", "post_cleaned"], f"""SELECT {kept} FROM {comments}
            WHERE link_id IS NULL OR link_id NOT IN (SELECT link_id FROM post_cleaned)"""),
        "dirty_3_2_removed": (["post", "subreddit"], """SELECT link_id, subreddit_id FROM post
            WHERE subreddit_id IS NULL OR subreddit_id NOT IN
            (SELECT subreddit_id FROM subreddit WHERE subreddit_id > 't5_2')"""),
        "dirty_3_3_converted": (["doc_comments", "users_cleaned"], f"""SELECT {kept} FROM {comments}
            WHERE author IS NOT NULL AND author NOT IN (SELECT author FROM users_cleaned)"""),
        "dirty_4_1_raw": repeated("flat", "link_id"),
        "dirty_4_2_raw": repeated(twice, "id"),
        "dirty_4_3_raw": repeated("flat", "author"),
        "dirty_6_1_raw": (["flat"], """SELECT id, author_flair_text, author_flair_css_class FROM flat
            WHERE author IS NULL AND
            (author_flair_text IS NOT NULL OR author_flair_css_class IS NOT NULL)"""),
        "dirty_7_2_converted": (["doc_comments", "post_cleaned"], f"""SELECT {kept} FROM {comments}
            WHERE parent_id LIKE 't3_%' AND parent_id NOT IN (SELECT link_id FROM post_cleaned)"""),
    }


def _cleaning_sql() -> dict[str, tuple[list[str], str]]:
    tables = schemas.CLEANED_TABLES
    sql: dict[str, tuple[list[str], str]] = {}
    for t in tables:
        names = ", ".join(_columns(t))
        difference = f"SELECT {names} FROM {t} EXCEPT SELECT {names} FROM {t}_cleaned"
        label = {"post": "posts", "comment": "comments"}.get(t, t)
        order = ", ".join(f"{c} ASC NULLS LAST" for c in _columns(t))
        reads = [t, f"{t}_cleaned"]
        sql[f"clean_{t}"] = ([f"{t}_cleaned"], f"SELECT * FROM {t}_cleaned")
        sql[f"ver_{t}_removed"] = (reads, f"SELECT count(*) AS {label}_removed FROM ({difference})")
        sql[f"ver_{t}_sample"] = (reads, f"SELECT * FROM ({difference}) ORDER BY {order} LIMIT 10")
    drops = {
        "users": f"CASE WHEN {_blank('author')} THEN 'dropped_missing_author' END",
        "subreddit": f"CASE WHEN {_blank('subreddit_id')} THEN 'dropped_missing_subreddit_id' END",
        "post": _POST_DROP,
        "comment": _COMMENT_DROP,
        "moderation": f"""CASE WHEN {_blank('target_id')} THEN 'dropped_missing_target_id'
            WHEN {_blank('subreddit_id')} THEN 'dropped_missing_subreddit_id' END""",
    }
    reasons = {
        "users": ["dropped_missing_author"],
        "subreddit": ["dropped_missing_subreddit_id"],
        "post": ["dropped_missing_subreddit_id", "dropped_invalid_created_utc"],
        "comment": ["dropped_missing_link_id", "dropped_missing_body",
                    "dropped_deleted_or_removed", "dropped_invalid_created_utc"],
        "moderation": ["dropped_missing_target_id", "dropped_missing_subreddit_id"],
    }
    fixes = {
        "users": {"flair_symbols_only_to_null": f"r IS NULL AND {_SYMBOL_FLAIR}"},
        "post": {"edited_negative_to_null": "r IS NULL AND edited < 0"},
        "comment": {
            "author_empty_to_null":
                f"NOT {_blank('link_id')} AND author IS NOT NULL AND {_blank('author')}",
            "score_fixed_from_ups_downs": f"r IS NULL AND {_WRONG_SCORE}",
        },
    }
    parts = []
    for t in tables:
        counters = {"seen": "TRUE", "processed": "TRUE", "kept": "r IS NULL",
                    **{r: f"r = '{r}'" for r in reasons[t]}, **fixes.get(t, {})}
        parts += [
            f"SELECT '{t}' AS table_name, '{name}' AS counter, "
            f"count(*) FILTER ({condition}) AS row_count FROM (SELECT *, {drops[t]} AS r FROM {t})"
            for name, condition in counters.items()
        ]
    sql["clean_stats"] = (tables, " UNION ALL ".join(parts))
    sql["clean_totals"] = (tables, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}" for t in tables))
    counts = [
        f"(SELECT count(*) FROM {t}{suffix}) AS {label}_{'mod' if t == 'moderation' else t}"
        for t in tables for label, suffix in (("raw", ""), ("clean", "_cleaned"))
    ]
    sql["ver_counts"] = ([*tables, *[f"{t}_cleaned" for t in tables]], f"SELECT {', '.join(counts)}")
    sql["ver_bad_times"] = (["comment_cleaned"], f"""
        SELECT count(*) AS invalid_comment_timestamps FROM comment_cleaned WHERE {_bad_time()}""")
    sql["ver_deleted_bodies"] = (["comment_cleaned"], f"""
        SELECT count(*) AS deleted_or_removed_bodies FROM comment_cleaned WHERE {_mentions()}""")
    sql["ver_bad_scores"] = (["comment_cleaned"], f"""
        SELECT count(*) AS incorrect_scores FROM comment_cleaned WHERE {_WRONG_SCORE}""")
    sql["ver_orphans"] = (["comment_cleaned", "post_cleaned"], """
        SELECT count(*) AS orphan_comments FROM comment_cleaned c
        LEFT JOIN post_cleaned p ON c.link_id = p.link_id WHERE p.link_id IS NULL""")
    return sql


def _tables() -> dict[str, tuple[str, list[str]]]:
    return {"comments_raw": ("flat", schemas.FLAT.names),
            **{t: (t, s.names) for t, s in schemas.RELATIONAL.items()}}


def _fd_sql(source: str, determinant: Sequence[str], dependents: Sequence[str]) -> str:
    """Violations and groups by counting distinct values per group."""
    bad = " OR ".join(f"count(DISTINCT {y}) > 1" for y in dependents)
    present = " AND ".join(f"{x} IS NOT NULL" for x in determinant)
    keys = ", ".join(determinant)
    return f"""SELECT '{keys}' AS determinant, '{', '.join(dependents)}' AS dependent,
        count(*) FILTER (bad) = 0 AND count(*) > 0 AS holds,
        count(*) FILTER (bad) AS violations, count(*) AS total_groups
        FROM (SELECT {bad} AS bad FROM {source} WHERE {present} GROUP BY {keys})"""


def _described(table: str, fd: str, kind: str, description: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{table}' AS table_name, determinant, dependent, '{kind}' AS fd_type, holds,
        violations, total_groups, {description} AS description FROM ({fd})"""


def _domain_sql(table: str, source: str, columns: Sequence[str]) -> str:
    return " UNION ALL ".join(
        _described(table, _fd_sql(source, [x], [y]), "Domain-Based", _quoted(text))
        for x, y, text in DOMAIN_DEPENDENCIES if x in columns and y in columns)


def _domain_all() -> str:
    return " UNION ALL ".join(
        part for part in (_domain_sql(t, s, c) for t, (s, c) in _tables().items()) if part)


def _unique_sql(outside_key: bool, condition: str) -> str:
    parts = [
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count,
            count(*) AS row_count FROM {source}"""
        for t, (source, columns) in _tables().items() for c in columns
        if not (outside_key and c in schemas.PRIMARY_KEYS.get(t, []))
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {condition}"


def _candidate_deps(tables: dict[str, tuple[str, list[str]]] | None = None) -> str:
    parts = []
    for t, (source, columns) in (tables or _tables()).items():
        open_columns = [c for c in columns if c not in schemas.PRIMARY_KEYS.get(t, [])]
        for c in open_columns:
            others = ", ".join(o for o in open_columns if o != c)
            if not others:
                continue
            parts.append(f"""
                SELECT '{t}' AS table_name, '{c}' AS determinant, '{others}' AS dependent,
                       'Candidate Key' AS fd_type, TRUE AS holds, CAST(0 AS BIGINT) AS violations,
                       count(*) AS total_groups, CAST(NULL AS VARCHAR) AS description
                FROM {source} HAVING count(*) > 0 AND count(DISTINCT {c}) = count(*)""")
    return " UNION ALL ".join(parts)


def _primary_sql() -> str:
    parts = [
        _described(t, _fd_sql(t, schemas.PRIMARY_KEYS[t],
                              [c for c in _columns(t) if c not in schemas.PRIMARY_KEYS[t]]),
                   "Primary Key")
        for t in schemas.RELATIONAL
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE holds"


def _example_sql(determinant: str, dependents: Sequence[str], source: str = "flat") -> str:
    case = "CASE " + " ".join(
        f"WHEN count(DISTINCT {y}) > 1 THEN '{y}'" for y in dependents) + " END"
    value = "CASE " + " ".join(
        f"WHEN d = '{y}' THEN CAST({y} AS VARCHAR)" for y in dependents) + " END"
    sort = dependents[0] if len(dependents) == 1 else value
    return f"""
        SELECT '{determinant}' AS determinant, CAST(k AS VARCHAR) AS determinant_value,
               d AS dependent_column, string_agg(v, ', ' ORDER BY r) AS dependent_values
        FROM (SELECT k, d, v, row_number() OVER (PARTITION BY k ORDER BY s) AS r
              FROM (SELECT DISTINCT k, d, {value} AS v, {sort} AS s
                    FROM {source} JOIN (SELECT * FROM (SELECT {determinant} AS k, {case} AS d FROM {source}
                          WHERE {determinant} IS NOT NULL GROUP BY 1) WHERE d IS NOT NULL
                          ORDER BY k LIMIT 3) ON {determinant} = k)
              WHERE v IS NOT NULL)
        WHERE r <= 3 GROUP BY k, d"""


def _dependency_sql() -> dict[str, tuple[list[str], str]]:
    reads = ["flat", *schemas.RELATIONAL]
    flair = ["author_flair_text", "author_flair_css_class"]
    samples = [_example_sql(x, [y]) for x, y, _ in DOMAIN_DEPENDENCIES]
    samples.append(_example_sql("author", ["author_flair_css_class", "author_flair_text"]))
    return {
        "fd_check": (["flat"], _fd_sql("flat", ["author"], flair) + " UNION ALL "
                     + _fd_sql("flat", ["author", "link_id"], ["body", "score"])),
        "fd_examples": (["flat"], " UNION ".join(samples)),
        "fd_primary_key": (list(schemas.RELATIONAL), _primary_sql()),
        "fd_candidate_keys": (reads, _unique_sql(True, "row_count > 0 AND distinct_count = row_count")),
        "fd_candidate_deps": (reads, _candidate_deps()),
        "fd_domain": (reads, _domain_all()),
        "fd_uniqueness": (reads, _unique_sql(False, "distinct_count > row_count * 0.9::DOUBLE")),
        "fd_summary": (reads, f"""
            SELECT CAST({' + '.join(f'(SELECT count(*) > 0 FROM {s})::BIGINT' for s, _ in _tables().values())}
                        AS BIGINT) AS total_tables, count(*) AS total_fds
            FROM ({_primary_sql()} UNION ALL {_candidate_deps()} UNION ALL {_domain_all()})"""),
    }


def _mining_sql() -> dict[str, tuple[list[str], str]]:
    def items(expression: str) -> tuple[list[str], str]:
        return ["mining_input"], f"""SELECT item, count(*) AS row_count
            FROM (SELECT unnest({expression}) AS item FROM mining_input)
            WHERE item IS NOT NULL GROUP BY item"""

    def itemsets(min_support: float) -> str:
        return f"""SELECT array_to_string(items, ', ') AS items, freq, support, length FROM supports
                   WHERE support >= CAST({min_support} AS DOUBLE)"""

    low = _rules(LOW_SUPPORT, LOW_CONFIDENCE)
    columns = "antecedents, consequents, support, confidence"
    return {
        "mine_input": (["mining_input"], "SELECT * FROM mining_input"),
        "mine_items_subreddit": items(
            "[CASE WHEN subreddit IS NOT NULL THEN concat('subreddit:', subreddit) END]"),
        "mine_items_score": items(f"[{_SCORE_BAND}]"),
        "mine_items_flags": items("""[CASE WHEN gilded > 0 THEN 'gilded' END,
            CASE WHEN controversiality > 0 THEN 'controversial' END,
            CASE WHEN edited <> 0 THEN 'edited' END,
            CASE WHEN distinguished <> 'None' THEN 'distinguished' END,
            CASE WHEN archived = 1 THEN 'archived' END]"""),
        "mine_transactions": (["item_lists"],
            "SELECT array_to_string(items, ', ') AS items FROM item_lists"),
        "mine_transaction_counts": (["item_lists"], """
            SELECT array_to_string(items, ', ') AS items, count(*) AS n FROM item_lists GROUP BY 1"""),
        "mine_encode": (["item_lists"], """
            SELECT (SELECT count(*) FROM item_lists) AS transactions,
                   (SELECT count(DISTINCT i) FROM (SELECT unnest(items) AS i FROM item_lists))
                   AS unique_items"""),
        "mine_itemsets": (["supports"], itemsets(0.01)),
        "mine_itemsets_low": (["supports"], itemsets(LOW_SUPPORT)),
        "mine_itemsets_any_width": (["supports"], itemsets(0.01)),
        "mine_rules": (["supports"], f"SELECT {columns} FROM ({low})"),
        "mine_rules_default": (["supports"], f"SELECT {columns} FROM ({_rules(0.01, 0.5)})"),
        "mine_metrics": (["supports"], low),
        "mine_top_rules": (["supports"], f"""
            SELECT * FROM ({low})
            ORDER BY confidence DESC, lift DESC, antecedents, consequents LIMIT 20"""),
        "mine_top_itemsets": (["supports"], f"""
            SELECT * FROM ({itemsets(0.01)}) ORDER BY support DESC, items LIMIT 50"""),
        "mine_summary": (["supports", "item_lists"], f"""
            SELECT (SELECT count(*) FROM item_lists) AS transactions,
                   (SELECT count(*) FROM ({itemsets(LOW_SUPPORT)})) AS frequent_itemsets,
                   count(*) AS association_rules, round(avg(confidence), 4) AS average_confidence,
                   round(avg(lift), 4) AS average_lift,
                   count(*) FILTER (lift > 1) AS rules_with_positive_lift FROM ({low})"""),
    }


def expected_sql() -> dict[str, str]:
    """Query name -> statement; names without one have no single right answer."""
    groups = [
        _source_sql(), _sink_sql(), _normalization_sql(), _document_sql(), _check_sql(),
        _analytics_sql(), _dirty_sql(), _cleaning_sql(), _dependency_sql(), _mining_sql(),
    ]
    stated = {name: parts for group in groups for name, parts in group.items()}
    stated["bench_layout_collections"] = (
        sorted({r for name in COLLECTION_QUERIES for r in stated[name][0]}),
        " UNION ALL ".join(
            f"SELECT '{name}' AS query, count(*) AS rows_before, count(*) AS rows_after "
            f"FROM ({stated[name][1]})" for name in COLLECTION_QUERIES))
    return {name: _with(reads, body) for name, (reads, body) in stated.items()}
