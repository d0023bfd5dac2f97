"""SQL counterparts of the registered queries, for DuckDB.

Written from the rules, with other constructs than the operators use where SQL has them: grouping with
``min`` and ``arg_min`` for keep-first, ``string_agg`` for rendering, a recursive walk for packing.
"""

from __future__ import annotations

from . import frames as fr

ORACLES: dict[str, str] = {}

# White space as SQL text and as an RE2 class.
SPACES = (
    "'\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　'"
)
RUNS = (
    r"'[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {RUNS}, ' ', 'g'), ' ')"


def key(x: str) -> str:
    return collapse(f"lower(substring({x}, 1, 300))")


def digest(x: str) -> str:
    return f"substring(sha256({key(x)}), 1, 32)"


def cut(x: str, cap: int) -> str:
    return (
        f"(CASE WHEN length({x}) > {cap + 5} THEN left({x}, {cap} - 15) || ' [...truncated]' ELSE {x} END)"
    )


def json_chars(x: str) -> str:
    """Length inside an ASCII JSON string, character by character."""
    return f"""list_sum(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: CASE
        WHEN c IN ('"', '\\', chr(8), chr(9), chr(10), chr(12), chr(13)) THEN 2
        WHEN unicode(c) BETWEEN 32 AND 126 THEN 1
        WHEN unicode(c) < 65536 THEN 6 ELSE 12 END))"""


# -- frames ------------------------------------------------------------------------------------------

CTES = {
    "chat": """
        SELECT 'conv_' || conv_id AS id, conv_id AS row_idx, turn, role, text AS content
        FROM conversations""",
    "chat_b": """
        SELECT 'conv_' || conv_id AS id, conv_id AS row_idx, turn, role,
               CASE WHEN (conv_id + turn) % 7 = 0 THEN '   ' ELSE text END AS content
        FROM conversations""",
    "kept": f"SELECT * FROM chat_b WHERE {strip('content')} <> ''",
    # system turns of from/value sources count as the user's
    "kept_sent": f"""
        SELECT id, row_idx, turn, CASE WHEN role = 'assistant' THEN role ELSE 'user' END AS role, content
        FROM chat_b WHERE {strip('content')} <> ''""",
    "docs": """
        SELECT *, CASE doc_id % 5 WHEN 0 THEN upper(lang) WHEN 2 THEN upper(lang[1]) || lang[2:]
                  WHEN 4 THEN NULL ELSE lang END AS language,
               CASE WHEN doc_id % 11 = 0 THEN 'doc ' || doc_id
                    WHEN doc_id % 13 = 0 THEN ''
                    WHEN doc_id % 17 = 0 THEN NULL
                    WHEN doc_id % 19 = 0 THEN lpad(doc_id::VARCHAR, 65, '0')
                    WHEN doc_id % 23 = 0 THEN lpad(doc_id::VARCHAR, 64, '0')
                    WHEN doc_id % 29 = 0 THEN 'doc_' || doc_id || chr(10)
                    WHEN doc_id % 31 = 0 THEN 'row_' || lpad((doc_id % 250)::VARCHAR, 6, '0')
                    WHEN doc_id % 37 = 0 THEN 'r' || lpad((doc_id + 1)::VARCHAR, 7, '0')
                    WHEN doc_id % 5 = 0 THEN 'doc_' || (doc_id - 1)
                    ELSE 'doc_' || doc_id END AS made_id
        FROM documents""",
    "posts": """
        SELECT page_id, 'post_' || page_id AS id, html, url, page_id % 50 AS base_score,
               regexp_extract(html, '(?s)<title>(.*?)</title>', 1)
                   || CASE WHEN page_id % 2 = 0 THEN '? ' ELSE '' END AS title,
               strftime(make_timestamp((1700000000 + page_id * 86399) * 1000000), '%Y-%m-%d %H:%M:%S')
                   || '+00:00' AS timestamp
        FROM pages""",
    "scores": """
        SELECT doc_id AS ord, source, lang,
               CASE WHEN doc_id % 29 = 0 THEN 'gone_' ELSE 'doc_' END || doc_id AS key,
               CASE WHEN doc_id % 17 > 0 THEN 2 * quality + doc_id % 2 END AS conceptual,
               CASE WHEN doc_id % 17 > 0 THEN (n_chars // 10) % 4 END AS novelty,
               CASE WHEN doc_id % 17 > 0 THEN (3 - 2 * toxic)::BIGINT END AS well_formed,
               CASE WHEN doc_id % 17 = 0 THEN 'refusal' WHEN doc_id % 31 = 0 THEN NULL ELSE 'ok' END
                   AS status,
               CASE WHEN doc_id % 4 < 3 THEN lang END AS language,
               lpad((doc_id % 7)::VARCHAR, 4, '0') AS shard_id, 'doc_' || doc_id AS custom_id
        FROM labels JOIN documents USING (doc_id)""",
    "all_scores": """
        SELECT * FROM scores UNION ALL
        SELECT ord + 1000000000, source, lang, key, 2, 3, well_formed, status, language, shard_id, custom_id
        FROM scores WHERE ord % 23 = 0""",
    "picked": """
        SELECT key, arg_max(conceptual, ord) AS conceptual, arg_max(novelty, ord) AS novelty,
               arg_max(well_formed, ord) AS well_formed
        FROM all_scores
        WHERE status = 'ok' AND conceptual >= 2 AND novelty >= 1 AND well_formed >= 2
        GROUP BY key""",
    # what each kind of answer must be read as
    "raw": """
        SELECT doc_id, lpad((doc_id % 7)::VARCHAR, 4, '0') AS shard_id,
               CASE WHEN doc_id % 47 = 0 THEN 'none_' ELSE 'doc_' END || doc_id AS custom_id,
               'batch_' || doc_id % 7 AS batch_id, n_chars, source, lang,
               CASE WHEN doc_id % 37 = 0 THEN 'errored' WHEN doc_id % 41 = 0 THEN 'expired'
                    WHEN doc_id % 43 = 0 THEN 'unknown' END AS not_answered,
               2 * quality + doc_id % 2 AS c, (n_chars // 10) % 4 AS n, (3 - 2 * toxic)::BIGINT AS w,
               '{"conceptual": ' AS opening,
               ', "novelty": ' || n || ', "well_formed": ' || w AS middle
        FROM labels JOIN documents USING (doc_id)""",
    "texts": """
        SELECT *, CASE doc_id % 11
               WHEN 1 THEN opening || c || ', '
               WHEN 2 THEN '{"novelty": ' || n || '}'
               WHEN 3 THEN opening || '" ' || c || '"' || middle || ', "reasoning": "because"}'
               WHEN 4 THEN '[' || c || ']'
               WHEN 5 THEN opening || 'null' || middle || ', "reasoning": "because"}'
               WHEN 6 THEN opening || '"2.7"' || middle || ', "reasoning": "because"}'
               WHEN 7 THEN opening || '7' || middle || ', "reasoning": "because"}'
               WHEN 8 THEN opening || c || middle || '}'
               WHEN 9 THEN opening || c || '.7' || middle || ', "reasoning": "because"}'
               WHEN 10 THEN opening || 'true' || middle || ', "reasoning": null}'
               ELSE opening || c || middle || ', "reasoning": "because"}' END AS text,
               CASE doc_id % 11 WHEN 1 THEN 'not valid JSON' WHEN 2 THEN 'no conceptual'
               WHEN 4 THEN 'not a JSON object' WHEN 5 THEN 'conceptual is not an integer'
               WHEN 6 THEN 'conceptual is not an integer' END AS problem,
               CASE doc_id % 11 WHEN 7 THEN 7 WHEN 10 THEN 1 ELSE c END AS conceptual_read
        FROM raw""",
    "results": """
        SELECT *, CASE WHEN not_answered IS NOT NULL THEN not_answered
                       WHEN doc_id % 13 = 0 THEN 'refusal'
                       WHEN problem IS NOT NULL THEN 'parse_error: ' || problem ELSE 'ok' END AS status,
               CASE WHEN status = 'ok' THEN conceptual_read END AS conceptual,
               CASE WHEN status = 'ok' THEN n END AS novelty,
               CASE WHEN status = 'ok' THEN w END AS well_formed,
               CASE WHEN status = 'ok' AND doc_id % 11 = 8 THEN ''
                    WHEN status = 'ok' AND doc_id % 11 = 10 THEN NULL
                    WHEN status = 'ok' THEN 'because'
                    WHEN starts_with(status, 'parse_error') THEN left(text, 200) ELSE '' END AS reasoning,
               CASE WHEN not_answered IS NULL THEN n_chars ELSE 0 END AS input_tokens,
               CASE WHEN not_answered IS NULL AND doc_id % 3 > 0 THEN doc_id % 200 ELSE 0 END
                   AS output_tokens
        FROM texts""",
    "requests": """
        SELECT lpad((doc_id % 7)::VARCHAR, 4, '0') AS shard_id, 'doc_' || doc_id AS custom_id,
               CASE WHEN doc_id % 3 > 0 THEN 300 + 100 * (doc_id % 9) END AS max_tokens, text AS prompt
        FROM documents""",
    "manifests": """
        SELECT lpad((doc_id % 7)::VARCHAR, 4, '0') AS shard_id, 'doc_' || doc_id AS custom_id,
               'doc_' || doc_id AS conversation_hash, source, lang AS language, doc_id % 50 AS base_score
        FROM documents""",
    "copies": """
        SELECT 'doc_' || doc_id AS key, doc_id, text, 0 AS copy FROM documents""",
    # greedy packing of (scope, ordinal, n_bytes), at most 50 rows and 100,000 bytes
    "packing": """
        SELECT scope, ordinal, n_bytes, 0::BIGINT AS shard, 1::BIGINT AS held, n_bytes::BIGINT AS filled
        FROM sized WHERE ordinal = 0
        UNION ALL
        SELECT s.scope, s.ordinal, s.n_bytes,
               p.shard + (p.held + 1 > 50 OR p.filled + s.n_bytes > 100000)::BIGINT,
               CASE WHEN p.held + 1 > 50 OR p.filled + s.n_bytes > 100000 THEN 1 ELSE p.held + 1 END,
               CASE WHEN p.held + 1 > 50 OR p.filled + s.n_bytes > 100000 THEN s.n_bytes
                    ELSE p.filled + s.n_bytes END
        FROM packing p JOIN sized s ON s.scope = p.scope AND s.ordinal = p.ordinal + 1""",
}


def oracle(name: str, body: str, *ctes: str, extra: dict[str, str] | None = None) -> None:
    parts = [f"{c} AS ({CTES[c] if not (extra and c in extra) else extra[c]})" for c in ctes]
    recursive = "RECURSIVE " if "packing" in ctes else ""
    ORACLES[name] = (f"WITH {recursive}" + ",\n".join(parts) + "\n" if parts else "") + body


# -- scans and conversations ---------------------------------------------------------------------

oracle(
    "scan_with_ordinals",
    """SELECT doc_id, lang, (row_number() OVER (ORDER BY doc_id)) - 1 AS row_idx,
              (row_number() OVER (PARTITION BY lang ORDER BY doc_id)) - 1 AS ordinal
       FROM documents""",
)
oracle("scan_appended_folder", "SELECT doc_id, lang, 1::BIGINT AS n_rows FROM documents")
_SHOWN = "string_agg(role || ': ' || content, chr(10) ORDER BY turn)"
_LONG = """
    SELECT 'long_' || conv_id // 10 AS id, conv_id // 10 AS row_idx, 1000 * (conv_id % 10) + turn AS turn, role,
           CASE WHEN (conv_id + turn) % 7 = 0 THEN '   ' ELSE text END AS content
    FROM conversations"""
_OF_LONG = """SELECT id, row_idx, count(*) AS n_turns, count(*) FILTER (role = 'user') AS n_user_turns,
               coalesce(arg_min(content, turn) FILTER (role = 'user' AND content <> ''), '') AS first_user"""
oracle("assemble_long_conversations", f"{_OF_LONG}, {_SHOWN} AS conversation FROM ({_LONG}) GROUP BY id, row_idx")
oracle(
    "conversation_chunks",
    f"""SELECT id, row_number() OVER (PARTITION BY id ORDER BY cut) - 1 AS chunk,
               coalesce(sum(n) OVER (PARTITION BY id ORDER BY cut ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_turn,
               n AS n_turns, shown AS conversation, n_turns AS turns_in_all, n_user_turns AS user_turns_in_all, first_user
        FROM (SELECT id, turn // 1000 AS cut, count(*) AS n, {_SHOWN} AS shown FROM ({_LONG}) GROUP BY ALL)
        JOIN ({_OF_LONG} FROM ({_LONG}) GROUP BY id, row_idx) USING (id)""",
)
oracle(
    "assemble_heads",
    f"""{_OF_LONG}, arg_min(content, turn) AS first_content,
        string_agg(role || ': ' || content, chr(10) ORDER BY turn) FILTER (nth <= 20) AS head
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn) AS nth FROM ({_LONG}))
        GROUP BY id, row_idx""",
)
oracle(
    "assemble_conversations",
    f"""SELECT id, row_idx, count(*) AS n_turns, count(*) FILTER (role = 'user') AS n_user_turns,
               coalesce(arg_min(content, turn) FILTER (role = 'user' AND content <> ''), '') AS first_user,
               arg_min(content, turn) AS first_content, {_SHOWN} AS head
        FROM chat_b GROUP BY id, row_idx""",
    "chat_b",
)
oracle(
    "map_roles",
    """SELECT id, turn, CASE role WHEN 'assistant' THEN role ELSE 'user' END AS role, content FROM chat""",
    "chat",
)
oracle("drop_blank_turns", "SELECT id, turn, role, content FROM kept", "chat_b", "kept")
oracle("user_turns_only", "SELECT id, turn, role, content FROM chat_b WHERE role = 'user'", "chat_b")
oracle(
    "fallback_conversation",
    """SELECT 'philosophy_se' AS source, a.doc_id AS row_idx, 2::BIGINT AS n_turns,
              left(CASE WHEN a.doc_id % 5 = 0 THEN a.source ELSE a.text END, 100) AS title, 24::BIGINT AS key_chars,
              min(a.doc_id) OVER (PARTITION BY CASE WHEN a.doc_id % 5 = 0 THEN a.source ELSE a.text END) AS first_row,
              'user: ' || CASE WHEN a.doc_id % 3 = 0 THEN a.source ELSE a.text END || chr(10)
                  || 'assistant: ' || coalesce(b.text, '') AS conversation
       FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1
       WHERE a.doc_id % 3 = 0 OR (a.doc_id % 5 > 0 AND a.text <> '')""",
)
oracle(
    "flatten_blocks",
    """SELECT id, turn, content || ' ' AS typed,
              CASE WHEN turn % 2 = 0 THEN content || ' ' ELSE content END AS loose FROM chat""",
    "chat",
)
oracle(
    "repair_stringified_turns",
    """SELECT doc_id, 0::BIGINT AS turn, 'user' AS role, text AS content FROM documents
       UNION ALL SELECT doc_id, 1, 'assistant', source FROM documents""",
)


def page_text(html: str) -> str:
    out = f"regexp_replace(regexp_replace({html}, '<[^>]+>', ' ', 'g'), {RUNS}, ' ', 'g')"
    # these names are also read without their semicolon
    for name, char in (
        ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("nbsp", "\xa0"),
        ("copy", "\xa9"), ("middot", "\xb7"), ("amp", "&"),
    ):
        out = f"regexp_replace({out}, '&{name};?', {quoted(char)}, 'g')"
    return strip(out)


oracle("html_to_text", f"SELECT page_id, {page_text('html')} AS text FROM pages")

# -- adapters ---------------------------------------------------------------------------------------


def forum(source: str, condition: str, full: bool = True) -> str:
    rest = ", url, base_score, timestamp, id" if full else ""
    return f"""
        SELECT '{source}' AS source, page_id AS row_idx, 1::BIGINT AS n_turns,
               {strip(f"{strip('title')} || chr(10) || chr(10) || {page_text('html')}")} AS first_user,
               {strip('title')} AS title, 'English' AS language, 'human' AS src_model{rest}
        FROM posts WHERE {condition}"""


def chats(
    source: str, kept: str, language: str = "'English'", model: str = "'human'",
    title: str = "NULL::VARCHAR", where: str = "TRUE", extra: str = "",
) -> str:
    return f"""
        SELECT '{source}' AS source, row_idx, count(*) AS n_turns,
               coalesce(arg_min(content, turn) FILTER (role = 'user' AND content <> ''), '') AS first_user,
               {title} AS title, {language} AS language, {model} AS src_model{extra}
        FROM {kept} WHERE {where} GROUP BY id, row_idx"""


_FLAGGED = forum("lesswrong", "page_id % 3 = 1")
_ASKED = forum("eaforum", f"ends_with({strip('title')}, '?')")
_ALSO = f", id, {_SHOWN} AS conversation"
_ENGLISH_ROWS = "row_idx % 4 < 2"
_FIRST_100 = "left(arg_min(content, turn), 100)"
_TREE = f"""
    SELECT 'oasst2' AS source, row_idx, 1::BIGINT AS n_turns, {strip('content')} AS first_user,
           NULL::VARCHAR AS title, 'English' AS language, 'human' AS src_model, id || '_' || turn AS id
    FROM chat_b
    WHERE turn = 0 AND role <> 'assistant' AND row_idx % 4 < 2 AND row_idx % 5 <> 1
          AND {strip('content')} <> ''"""


def arena(source: str, content: str) -> str:
    return f"""
        SELECT '{source}' AS source, doc_id AS row_idx, 1::BIGINT AS n_turns, {content} AS first_user,
               NULL::VARCHAR AS title, 'English' AS language, 'human' AS src_model, 'doc_' || doc_id AS id
        FROM docs WHERE lower(language) IN ('en', 'english') AND {strip('text')} <> ''"""


oracle("forum_flagged", _FLAGGED, "posts")
oracle("forum_interrogative", _ASKED, "posts")
oracle(
    "preference_chat",
    chats(
        "prism", "kept", where="role = 'user'",
        extra=_ALSO + ", CASE row_idx % 3 WHEN 0 THEN 'guided' WHEN 1 THEN 'open' END AS conversation_type",
    ),
    "chat_b", "kept",
)
oracle(
    "shared_chat",
    chats("sharegpt", "kept_sent", "NULL::VARCHAR", "'unknown'", extra=_ALSO),
    "chat_b", "kept_sent",
)
oracle(
    "gated_chat",
    chats("lmsys", "kept", model="'model-' || row_idx % 3", where=_ENGLISH_ROWS, extra=_ALSO),
    "chat_b", "kept",
)
for _name in ("preference_chat", "shared_chat", "gated_chat"):
    _source = {"preference_chat": "prism", "shared_chat": "sharegpt", "gated_chat": "lmsys"}[_name]
    ORACLES[f"{_source}_source"] = ORACLES[_name]
ORACLES["read_json_array_source"] = ORACLES["sharegpt_source"]
oracle(
    "qa_site_source",
    f"""SELECT * EXCLUDE (id, question), 24::BIGINT AS key_chars, min(row_idx) OVER (PARTITION BY question) AS first_row
        FROM ({chats("se_law", "kept_sent", title=_FIRST_100, extra=_ALSO + ", arg_min(content, turn) AS question")})""",
    "chat_b", "kept_sent",
)
oracle("tree_roots", _TREE, "chat_b")
oracle(
    "qa_site",
    chats("se_law", "kept_sent", title=_FIRST_100, extra=f", {_SHOWN} AS conversation"),
    "chat_b", "kept_sent",
)
oracle("arena_chat", arena("arena_140k", "text || ' '"), "docs")
oracle("arena_chat_printed", arena("arena_expert", "text"), "docs")
oracle(
    "chat_log",
    """SELECT 'hash_' || doc_id AS id, 'wildchat' AS source, doc_id AS row_idx, 2::BIGINT AS n_turns,
              text AS first_user, NULL::VARCHAR AS title, language, source AS src_model,
              strftime(make_timestamp(1700000000000000 + doc_id * 500000), '%Y-%m-%dT%H:%M:%S')
                  || CASE WHEN doc_id % 2 = 1 THEN '.500000' ELSE '' END || '+00:00' AS timestamp,
              CASE WHEN doc_id % 2 = 0 THEN 'France' END AS country, 1::BIGINT AS src_turn, 1::BIGINT AS n_user_turns
       FROM docs""",
    "docs",
)
_COLUMNS = "source, row_idx, n_turns, first_user, title, language, src_model"
_LOG = """
    SELECT 'wildchat' AS source, doc_id AS row_idx, 2::BIGINT AS n_turns, text AS first_user,
           NULL::VARCHAR AS title, language, source AS src_model FROM docs"""
_PAIRS = """
    SELECT 'philosophy_se' AS source, doc_id AS row_idx, 2::BIGINT AS n_turns,
           CASE WHEN doc_id % 3 = 0 THEN source ELSE text END AS first_user,
           left(CASE WHEN doc_id % 5 = 0 THEN source ELSE text END, 100) AS title, 'English' AS language,
           'human' AS src_model
    FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 5 > 0 AND text <> '')"""
oracle(
    "all_sources",
    "\nUNION ALL\n".join(
        f"SELECT {_COLUMNS} FROM ({part})"
        for part in (
            _FLAGGED, _ASKED, arena("arena_140k", "text || ' '"), arena("arena_expert", "text"), _TREE, _LOG, _PAIRS,
            chats("prism", "kept", where="role = 'user'"),
            chats("sharegpt", "kept_sent", "NULL::VARCHAR", "'unknown'"),
            chats("lmsys", "kept", model="'model-' || row_idx % 3", where=_ENGLISH_ROWS),
            chats("se_law", "kept_sent", title=_FIRST_100),
        )
    ),
    "posts", "docs", "chat_b", "kept", "kept_sent",
)

# -- filters and scalars ------------------------------------------------------------------------

oracle("filter_language", "SELECT doc_id, language FROM docs WHERE lower(language) = 'en'", "docs")
oracle(
    "filter_language_set",
    """SELECT doc_id, 'some' AS asked FROM docs WHERE lower(language) IN ('fr', 'de')
       UNION ALL SELECT doc_id, 'all' FROM docs""",
    "docs",
)
oracle(
    "filter_language_exact",
    """SELECT doc_id, 'EN' AS asked FROM docs WHERE language = 'EN'
       UNION ALL SELECT doc_id, '' FROM docs WHERE language IS NULL""",
    "docs",
)
oracle(
    "filter_nonempty",
    f"""SELECT id, bool_or(role = 'user' AND {key('content')} <> '') AS has_key FROM kept GROUP BY id""",
    "chat_b", "kept",
)
oracle(
    "valid_ids",
    """SELECT doc_id, coalesce(regexp_full_match(made_id, '[A-Za-z0-9_-]{1,64}'), FALSE) AS usable
       FROM docs""",
    "docs",
)
oracle(
    "dedup_keys",
    f"""SELECT doc_id, {key('text')} AS key, {digest('text')} AS digest,
               left({collapse('text')}, 90) AS preview,
               CASE WHEN {collapse('text')} = '' THEN '(no user content)'
                    WHEN length({collapse('text')}) > 70 THEN left({collapse('text')}, 70) || '…'
                    ELSE {collapse('text')} END AS scan_preview,
               length(text) AS n_chars, coalesce({json_chars('text')}, 0)::BIGINT AS json_chars
        FROM documents""",
)
oracle(
    "iso_timestamps",
    """SELECT event_id, replace(plain, ' ', 'T') || '+00:00' AS iso, plain
       FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S')
                 || CASE WHEN date_part('us', ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
                 AS plain FROM events)""",
)

# -- de-duplication -------------------------------------------------------------------------------

oracle(
    "keep_first",
    f"""SELECT doc_id, source, text FROM documents
        WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY {key('text')})""",
)
_BY_ID = "SELECT min(doc_id) AS doc_id FROM docs GROUP BY coalesce(made_id, '')"
_ADAPTER_KEPT = f"""
    SELECT min(doc_id) AS doc_id FROM docs
    WHERE doc_id IN ({_BY_ID}) AND {key('text')} <> '' GROUP BY {key('text')}"""
oracle(
    "keep_first_by_id_then_text",
    f"""SELECT coalesce(made_id, '') AS id, doc_id AS row_idx, text AS first_user
        FROM docs WHERE doc_id IN ({_ADAPTER_KEPT})""",
    "docs",
)
oracle(
    "keep_first_incremental",
    f"""SELECT arg_min(doc_id, (run, doc_id)) AS doc_id, min(run) AS run
        FROM (SELECT *, 1 + regexp_extract(source, '(\\d+)$', 1)::BIGINT % 2 AS run FROM documents)
        GROUP BY {key('text')}""",
)
oracle(
    "scan_dedup_counters",
    f"""SELECT count(*) AS rows_seen,
               count(*) FILTER (coalesce(lower(language), '') NOT IN ('en', 'de')) AS other_language,
               count(*) FILTER (lower(language) IN ('en', 'de'))
                   - count(DISTINCT {key('text')}) FILTER (lower(language) IN ('en', 'de')) AS duplicates,
               count(DISTINCT {key('text')}) FILTER (lower(language) IN ('en', 'de')) AS candidates
        FROM docs""",
    "docs",
)

# -- rendering and packing --------------------------------------------------------------------------

_CHAT_PROMPT = f"""
    SELECT id, {quoted(fr.PREFIX + "<conversation>")}
        || string_agg(CASE WHEN turn < 3 THEN chr(10) || '<turn index="' || (turn + 1) || '" role="' || role
               || '">' || chr(10) || CASE WHEN role = 'user' THEN {cut('content', 120)}
               ELSE {cut('content', 60)} END || chr(10) || '</turn>' ELSE '' END, '' ORDER BY turn)
        || CASE WHEN count(*) > 3 THEN chr(10) || '[' || (count(*) - 3) || ' later turn(s) omitted]'
           ELSE '' END
        || chr(10) || {quoted("</conversation>" + fr.SUFFIX)} AS prompt
    FROM chat GROUP BY id"""
oracle("render_prompts", _CHAT_PROMPT, "chat")
oracle(
    "render_long_texts",
    f"""SELECT doc_id, '<conversation>' || chr(10) || '<turn index="1" role="user">' || chr(10)
               || {cut('text', 4000)} || chr(10) || '</turn>' || chr(10)
               || '<turn index="2" role="assistant">' || chr(10) || {cut('text', 1500)} || chr(10)
               || '</turn>' || chr(10) || '</conversation>' AS prompt
        FROM documents""",
)
oracle(
    "parse_rendered_turns",
    f"""SELECT id, turn + 1 AS turn, role,
               trim(CASE WHEN role = 'user' THEN {cut('content', 120)} ELSE {cut('content', 60)} END,
                    chr(10)) AS content,
               CASE WHEN n > 3 THEN '[' || (n - 3) || ' later turn(s) omitted]' ELSE '' END AS note
        FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM chat) WHERE turn < 3""",
    "chat",
)


def numbered(rows: str, scope: str, fallback: str) -> str:
    """Ordinals and request ids of rows ``(doc_id, made_id)``."""
    width = fallback[-1]
    name = fallback[:-1]
    usable = f"""regexp_full_match(coalesce(made_id, ''), '[A-Za-z0-9_-]{{1,64}}')
                 AND NOT regexp_full_match(coalesce(made_id, ''), '{name}[0-9]+')"""
    return f"""
        SELECT *, {scope} AS scope, (row_number() OVER (PARTITION BY {scope} ORDER BY doc_id)) - 1 AS ordinal,
               CASE WHEN {usable} AND doc_id = min(doc_id) OVER (PARTITION BY {scope}, made_id)
                    THEN made_id
                    ELSE '{name}' || lpad(((row_number() OVER (PARTITION BY {scope} ORDER BY doc_id)) - 1)
                         ::VARCHAR, {width}, '0') END AS custom_id
        FROM ({rows})"""


_FILE = f"doc_id // {fr.FILE_ROWS}"
oracle(
    "request_ids",
    f"""SELECT 'file' AS scope, doc_id AS row_idx, ordinal, custom_id
        FROM ({numbered("SELECT doc_id, made_id FROM docs", _FILE, "row_6")})
        UNION ALL
        SELECT 'source', doc_id, ordinal, custom_id
        FROM ({numbered("SELECT doc_id, made_id FROM docs", "0", "r7")})""",
    "docs",
)
_SIZED_DOCS = {
    "sized": f"""SELECT doc_id, {_FILE} AS scope, length(text) AS n_bytes,
                        (row_number() OVER (PARTITION BY {_FILE} ORDER BY doc_id)) - 1 AS ordinal
                 FROM documents"""
}
_FILE_SHARD = "lpad(scope::VARCHAR, 4, '0') || '_' || lpad(shard::VARCHAR, 2, '0')"
oracle(
    "pack_shards",
    f"""SELECT doc_id AS row_idx, ordinal, {_FILE_SHARD} AS shard_id
        FROM packing JOIN sized USING (scope, ordinal)""",
    "sized", "packing",
    extra=_SIZED_DOCS,
)
oracle(
    "shard_stats",
    f"""SELECT {_FILE_SHARD} AS shard_id, count(*) AS n_requests, sum(n_bytes)::BIGINT AS n_bytes
        FROM packing GROUP BY scope, shard""",
    "sized", "packing",
    extra=_SIZED_DOCS,
)

# JSON texts of a request without id and prompt, and of the fingerprinted settings.
_REQUEST = (
    '{"custom_id": "", "params": {"model": "test-model", "max_tokens": 300, "output_config": '
    '{"format": {"type": "json_schema", "schema": {"type": "object", "properties": {'
    '"reasoning": {"type": "string"}, "conceptual": {"type": "integer", "enum": [0, 1, 2, 3]}, '
    '"novelty": {"type": "integer", "enum": [0, 1, 2, 3]}, '
    '"well_formed": {"type": "integer", "enum": [0, 1, 2, 3]}}, '
    '"required": ["reasoning", "conceptual", "novelty", "well_formed"], '
    '"additionalProperties": false}}}, "messages": [{"role": "user", "content": ""}]}}'
)
_SORTED_SCHEMA = (
    '{"additionalProperties": false, "properties": {'
    '"conceptual": {"enum": [0, 1, 2, 3], "type": "integer"}, '
    '"novelty": {"enum": [0, 1, 2, 3], "type": "integer"}, "reasoning": {"type": "string"}, '
    '"well_formed": {"enum": [0, 1, 2, 3], "type": "integer"}}, '
    '"required": ["reasoning", "conceptual", "novelty", "well_formed"], "type": "object"}'
)
_TEMPLATE = fr.PREFIX + "<conversation>\n</conversation>" + fr.SUFFIX
_FINGERPRINT = f"""left(sha256('{{"dedup_prefix": 300, "language": "en", "max_other_chars": 1500, "max_turns": 20, '
    || '"max_user_chars": 4000, "model": "test-model", "schema_sha": "'
    || left(sha256({quoted(_SORTED_SCHEMA)}), 16) || '", "template_sha": "'
    || left(sha256({quoted(_TEMPLATE)}), 16) || '"}}'), 16)"""

_DOC_PROMPT = f"""{quoted(fr.PREFIX + '<conversation>')} || chr(10) || '<turn index="1" role="user">'
    || chr(10) || {cut('text', 4000)} || chr(10) || '</turn>' || chr(10)
    || {quoted('</conversation>' + fr.SUFFIX)}"""


def prepared(kept: str, scope: str, fallback: str) -> dict[str, str]:
    return {
        "survivors": f"SELECT *, {_DOC_PROMPT} AS prompt FROM docs WHERE doc_id IN ({kept})",
        "numbers": numbered("SELECT * FROM survivors", scope, fallback),
        "sized": f"""SELECT *, (length({quoted(_REQUEST)}) + length(custom_id) + {json_chars('prompt')})::BIGINT
                            AS n_bytes FROM numbers""",
        "prepared": f"""SELECT sized.*, shard, {_FILE_SHARD} AS shard_id,
                               CASE WHEN doc_id % 4 = 0 THEN upper(lang) ELSE lang END AS spoken
                        FROM packing JOIN sized USING (scope, ordinal)""",
    }


_KEPT = f"SELECT min(doc_id) FROM docs WHERE lang = 'en' GROUP BY {key('text')}"
_CHAT_RUN = prepared(_KEPT, _FILE, "row_6")
_EN_BY_ID = "SELECT min(doc_id) FROM docs WHERE lang = 'en' GROUP BY coalesce(made_id, '')"
_ADAPTER_RUN = prepared(
    f"""SELECT min(doc_id) FROM docs WHERE doc_id IN ({_EN_BY_ID}) AND {key('text')} <> ''
        GROUP BY {key('text')}""",
    "0",
    "r7",
)
_STEPS = ("docs", "survivors", "numbers", "sized", "packing", "prepared")


def run_oracle(name: str, body: str, run: dict[str, str] = _CHAT_RUN) -> None:
    oracle(name, body, *_STEPS, extra=run)


run_oracle(
    "prepare",
    """SELECT scope AS file_idx, doc_id AS row_idx, ordinal, custom_id, shard_id, prepared.n_bytes,
              length(prompt) AS prompt_chars FROM prepared""",
)
run_oracle(
    "prepare_adapter",
    """SELECT doc_id AS row_idx, ordinal, custom_id, lpad(shard::VARCHAR, 4, '0') AS shard_id,
              prepared.n_bytes FROM prepared""",
    _ADAPTER_RUN,
)
run_oracle(
    "prepare_report",
    f"""SELECT 'documents' AS source, {_FILE} AS file_idx, count(*) AS rows_in_language,
               count(p.doc_id) AS survivors, count(DISTINCT p.shard_id) AS n_shards
        FROM docs d LEFT JOIN (SELECT doc_id, shard_id FROM prepared) p USING (doc_id)
        WHERE d.lang = 'en' GROUP BY 2""",
)
run_oracle(
    "prepare_totals",
    """SELECT count(*) AS survivors, sum(length(prompt))::BIGINT AS total_prompt_chars,
              count(DISTINCT shard_id) AS n_shards FROM prepared""",
)
run_oracle(
    "manifest",
    f"""SELECT shard_id, custom_id, 'documents' AS source, coalesce(made_id, '') AS conversation_hash,
               spoken AS language, source AS src_model, 1::BIGINT AS src_turn, 1::BIGINT AS n_turns,
               left({collapse('text')}, 90) AS first_user_preview, length(prompt) AS prompt_chars
        FROM prepared""",
)
run_oracle(
    "requests",
    """SELECT custom_id, 'test-model' AS model, 300::BIGINT AS max_tokens, 'json_schema' AS format,
              'user' AS role, prompt FROM prepared""",
)
run_oracle(
    "write_read_shards",
    f"""SELECT shard_id, custom_id, {_FINGERPRINT} AS fingerprint, length(prompt) AS prompt_chars,
               'reasoning' AS first_field FROM prepared""",
)

run_oracle(
    "config_drift",
    f"""SELECT shard_id, CASE WHEN uneven THEN {_FINGERPRINT.replace("test-model", "next-model")} ELSE {_FINGERPRINT} END AS fingerprint,
               count(*) AS n_requests, uneven AS drifted
        FROM (SELECT shard_id, right(shard_id, 1)::INT % 2 = 1 AS uneven FROM prepared) GROUP BY shard_id, uneven""",
)

# -- scoring and results ------------------------------------------------------------------------


def _cues(axis: str) -> str:
    found = " + ".join(f"contains(low, {quoted(c)})::INT" for c in fr.CUES[axis])
    return f"least(3, {found})::BIGINT"


_SCORED = f"""
    SELECT doc_id, 'ok' AS status, conceptual, novelty, well_formed, reasoning,
           length(prompt) // 4 AS input_tokens,
           length('{{"reasoning": "' || reasoning || '", "conceptual": 0, "novelty": 0, "well_formed": 0}}')
               // 4 AS output_tokens
    FROM (SELECT doc_id, prompt, {_cues('conceptual')} AS conceptual, {_cues('novelty')} AS novelty,
                 {_cues('well_formed')} AS well_formed, 'cues in ' || length(prompt) || ' chars' AS reasoning
          FROM (SELECT doc_id, prompt, lower(prompt) AS low
                FROM (SELECT doc_id, {_DOC_PROMPT} AS prompt FROM documents)))"""
oracle("score_prompts", _SCORED)
_READ = ("raw", "texts", "results")
_RESULT = """shard_id, custom_id, batch_id, status, conceptual, novelty, well_formed, reasoning,
    input_tokens, output_tokens"""
oracle("parse_responses", f"SELECT {_RESULT} FROM results", *_READ)
oracle(
    "parse_responses_strict",
    """SELECT shard_id, custom_id, batch_id,
              CASE WHEN lacking THEN 'parse_error: no reasoning' ELSE status END AS status,
              CASE WHEN NOT lacking THEN conceptual END AS conceptual,
              CASE WHEN NOT lacking THEN novelty END AS novelty,
              CASE WHEN NOT lacking THEN well_formed END AS well_formed,
              CASE WHEN not_answered IS NOT NULL THEN text
                   WHEN status = 'refusal' THEN 'refusal'
                   WHEN lacking THEN 'parse error: no reasoning: ' || left(text, 200)
                   WHEN status = 'ok' THEN reasoning
                   ELSE 'parse error: ' || problem || ': ' || left(text, 200) END AS reasoning,
              input_tokens, output_tokens
       FROM (SELECT *, status = 'ok' AND doc_id % 11 = 8 AS lacking FROM results)""",
    *_READ,
)
_RANGED = "CASE WHEN status = 'ok' AND doc_id % 11 = 7 THEN 'out_of_range' ELSE status END"
oracle(
    "range_check",
    f"SELECT custom_id, {_RANGED} AS status, conceptual, novelty, well_formed FROM results",
    *_READ,
)
oracle(
    "attach_manifest",
    """SELECT r.shard_id, r.custom_id, status, conversation_hash, m.source, m.language
       FROM results r LEFT JOIN manifests m USING (custom_id)""",
    *_READ, "manifests",
)
oracle(
    "write_read_results",
    """SELECT r.shard_id, r.custom_id, batch_id, status, conceptual, novelty, well_formed, reasoning,
              m.source, base_score
       FROM results r LEFT JOIN manifests m USING (custom_id)""",
    *_READ, "manifests",
)
oracle(
    "retry_set",
    """SELECT shard_id, custom_id, greatest(coalesce(max_tokens, 300), 600) AS max_tokens, prompt
       FROM requests WHERE custom_id IN (SELECT custom_id FROM results WHERE status <> 'ok')""",
    *_READ, "requests",
)
oracle(
    "patch_results",
    """SELECT shard_id, custom_id, batch_id, CASE WHEN mended THEN 'ok' ELSE status END AS status,
              CASE WHEN mended AND n_chars % 5 = 0 THEN 3 WHEN mended THEN 1 ELSE conceptual END AS conceptual,
              CASE WHEN mended THEN 2 ELSE novelty END AS novelty,
              CASE WHEN mended THEN 3 ELSE well_formed END AS well_formed,
              CASE WHEN mended THEN 'again' ELSE reasoning END AS reasoning,
              CASE WHEN mended THEN n_chars ELSE input_tokens END AS input_tokens,
              CASE WHEN mended AND doc_id % 3 > 0 THEN doc_id % 200 WHEN mended THEN 0
                   ELSE output_tokens END AS output_tokens
       FROM (SELECT *, status <> 'ok' AND (n_chars % 3 <> 0 OR n_chars % 5 = 0) AS mended FROM results)""",
    *_READ,
)
oracle(
    "patch_shards_on_disk",
    """SELECT shard_id, custom_id, CASE WHEN mended THEN 'ok' ELSE status END AS status,
              CASE WHEN mended AND n_chars % 5 = 0 THEN 3 WHEN mended THEN 1 ELSE conceptual END AS conceptual,
              CASE WHEN mended THEN 2 ELSE novelty END AS novelty,
              CASE WHEN mended THEN 3 ELSE well_formed END AS well_formed,
              CASE WHEN mended THEN 'again' ELSE reasoning END AS reasoning,
              CASE WHEN mended THEN n_chars ELSE input_tokens END AS input_tokens,
              CASE WHEN mended AND doc_id % 3 > 0 THEN doc_id % 200 WHEN mended THEN 0
                   ELSE output_tokens END AS output_tokens
       FROM (SELECT *, status <> 'ok' AND shard_id > '0000' AND (n_chars % 3 <> 0 OR n_chars % 5 = 0) AS mended FROM results)""",
    *_READ,
)
oracle(
    "patch_counts",
    """SELECT count(*) FILTER (n_chars % 3 <> 0 OR n_chars % 5 = 0) AS fixed,
              count(*) FILTER (n_chars % 3 = 0 AND n_chars % 5 <> 0) AS still_failing
       FROM results WHERE status <> 'ok'""",
    *_READ,
)
oracle(
    "pending_shards",
    """SELECT shard_id, custom_id FROM requests
       EXCEPT SELECT shard_id, custom_id FROM raw""",
    "requests", "raw",
)

# -- publishing and rebuilding -------------------------------------------------------------------

oracle(
    "score_table",
    """SELECT coalesce(m.source, 'documents') AS source, conversation_hash AS key, conceptual, novelty,
              well_formed, status, NULL::VARCHAR AS src_model, NULL::VARCHAR AS timestamp,
              NULL::VARCHAR AS country, m.language, CASE WHEN m.custom_id IS NOT NULL THEN 1::BIGINT END AS n_turns,
              base_score, NULL::VARCHAR AS url
       FROM results r LEFT JOIN manifests m USING (custom_id)""",
    *_READ, "manifests",
)
_AXES = "conceptual, novelty, well_formed"
oracle(
    "strong_hits",
    f"""SELECT ord, key, {_AXES} FROM all_scores
        WHERE status = 'ok' AND least(conceptual, novelty, well_formed) >= 2
              AND conceptual IS NOT NULL""",
    "scores", "all_scores",
)
oracle(
    "conceptual_hits",
    f"SELECT ord, key, {_AXES} FROM all_scores WHERE status = 'ok' AND conceptual >= 2",
    "scores", "all_scores",
)
_PICKED_LOW = """
    SELECT key, arg_max(conceptual, ord) AS conceptual, arg_max(novelty, ord) AS novelty,
           arg_max(well_formed, ord) AS well_formed
    FROM all_scores WHERE status = 'ok' AND conceptual >= 1 AND novelty >= 1 AND well_formed >= 1
    GROUP BY key"""
oracle("select_keys", _PICKED_LOW, "scores", "all_scores")
oracle(
    "rebuild_prompts",
    f"""SELECT key, 'documents' AS source, {_AXES}, 'http://example.com/' || doc_id AS url,
               left(text, 100) AS title, 'user: ' || text AS conversation
        FROM picked JOIN copies USING (key)""",
    "scores", "all_scores", "picked", "copies",
)
ORACLES["rebuild_prompts_in_place"] = ORACLES["rebuild_prompts"]
oracle(
    "rebuild_source",
    f"""SELECT id AS key, 'sharegpt' AS source, {_AXES}, conversation FROM ({_PICKED_LOW}) AS p
        JOIN (SELECT id, {_SHOWN} AS conversation FROM kept_sent GROUP BY id) AS c ON c.id = replace(key, 'doc_', 'conv_')""",
    "scores", "all_scores", "chat_b", "kept_sent",
)
oracle(
    "rebuild_turns",
    f"""SELECT id AS key, turn, role, content, {_AXES}
        FROM chat JOIN ({_PICKED_LOW}) p ON p.key = replace(id, 'conv_', 'doc_')""",
    "scores", "all_scores", "chat",
)
oracle(
    "missing_keys",
    "SELECT key FROM picked WHERE key NOT IN (SELECT key FROM copies)",
    "scores", "all_scores", "picked", "copies",
)
oracle(
    "rebuild_coverage",
    """SELECT count(*) AS selected, count(*) FILTER (key IN (SELECT key FROM copies)) AS found,
              count(*) FILTER (key NOT IN (SELECT key FROM copies)) AS missing FROM picked""",
    "scores", "all_scores", "picked", "copies",
)
oracle(
    "write_read_rebuilt",
    f"""SELECT key, {_AXES}, 'user: ' || text AS conversation, 'documents_c2n1w2.jsonl' AS name
        FROM picked JOIN copies USING (key)""",
    "scores", "all_scores", "picked", "copies",
)
_SHOWABLE = "coalesce(status, 'ok') = 'ok'"
oracle(
    "browse_order",
    f"""SELECT ord, key, {_AXES}, status FROM all_scores
        WHERE {_SHOWABLE} AND conceptual >= 1 AND novelty >= 0 AND well_formed >= 1
        ORDER BY novelty DESC, conceptual DESC, well_formed DESC, ord LIMIT 25""",
    "scores", "all_scores",
)
oracle(
    "browse_window",
    f"""SELECT ord, key, {_AXES} FROM all_scores
        WHERE {_SHOWABLE} AND conceptual IS NOT NULL AND language = 'en'
        ORDER BY well_formed DESC, conceptual DESC, novelty DESC, ord LIMIT 20 OFFSET 10""",
    "scores", "all_scores",
)
oracle(
    "browse_window_deep",
    f"""SELECT ord, key, {_AXES} FROM (
          SELECT *, row_number() OVER (ORDER BY novelty DESC NULLS LAST, conceptual DESC NULLS LAST, well_formed DESC NULLS LAST, ord) AS nth,
                 count(*) OVER () * 9 // 10 AS start FROM all_scores WHERE {_SHOWABLE})
        WHERE nth > start AND nth <= start + 20""",
    "scores", "all_scores",
)
oracle(
    "hit_prompts",
    f"""SELECT s.shard_id, CASE WHEN ord % 13 = 0 THEN 'none_' || ord ELSE s.custom_id END AS custom_id, {_AXES},
               text AS prompt
        FROM scores s LEFT JOIN documents d ON doc_id = ord AND ord % 13 > 0
        WHERE status = 'ok' AND conceptual >= 2 AND novelty >= 2 AND well_formed >= 2""",
    "scores",
)

# -- reports ----------------------------------------------------------------------------------------

oracle(
    "cost_estimate",
    """SELECT survivors, n_shards, input_tokens, output_tokens,
              round(input_tokens / survivors, 6) AS mean_prompt_tokens,
              round((input_tokens + 5.0 * output_tokens) / 1e6 * 0.5, 6) AS batch_cost,
              round((input_tokens + 5.0 * output_tokens) / 1e6, 6) AS sync_cost
       FROM (SELECT count(*) AS survivors, count(DISTINCT doc_id % 7) AS n_shards,
                    (sum(length(text)) / 4.0)::DOUBLE AS input_tokens, count(*) * 116 AS output_tokens
             FROM documents)""",
)
oracle(
    "cost_actual",
    """SELECT sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens,
              round((sum(input_tokens) + 5.0::DOUBLE * sum(output_tokens)) / 1e6, 6) AS cost FROM results""",
    *_READ,
)
_BUCKET = "CASE WHEN status IN ('ok', 'refusal') THEN status ELSE 'error' END"
_STATUS_COUNTS = f"""
    SELECT shard_id, {_BUCKET} AS bucket, count(*) AS n_rows, false AS is_total FROM results GROUP BY ALL
    UNION ALL SELECT NULL, {_BUCKET}, count(*), true FROM results GROUP BY ALL"""
oracle("status_counts", _STATUS_COUNTS, *_READ)
oracle(
    "score_histogram",
    " UNION ALL ".join(
        f"SELECT '{a}' AS axis, {a} AS score, count(*) AS n_rows FROM results WHERE {a} IS NOT NULL GROUP BY {a}"
        for a in ("conceptual", "novelty", "well_formed")
    ),
    *_READ,
)
oracle(
    "session_counters",
    """SELECT count(*) AS classified, count(*) FILTER (conceptual IS NULL) AS failures,
              count(*) FILTER (conceptual >= 2 AND novelty >= 0 AND well_formed >= 0) AS hits,
              sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens
       FROM results""",
    *_READ,
)
_PROGRESS = """sum(prepared) AS prepared, sum(collected) AS collected, sum(ok) AS ok, sum(collected) - sum(ok) AS failing,
    count(*) FILTER (collected > 0) AS shards_collected, count(*) AS shards
    FROM (SELECT shard_id, (SELECT count(*) FROM results r WHERE r.shard_id = q.shard_id) AS collected,
                 (SELECT count(*) FROM results r WHERE r.shard_id = q.shard_id AND status = 'ok') AS ok,
                 count(*) AS prepared FROM requests q GROUP BY shard_id)"""
oracle(
    "run_progress",
    f"""SELECT shard_id, false AS is_total, {_PROGRESS} GROUP BY shard_id
        UNION ALL SELECT NULL, true, {_PROGRESS}""",
    *_READ, "requests",
)
_YIELD = """count(*) AS n_rows, count(*) FILTER (status = 'ok' AND conceptual >= 2) AS conceptual_ge2,
    count(*) FILTER (status = 'ok' AND conceptual >= 2 AND novelty >= 2 AND well_formed >= 2) AS strong,
    count(*) FILTER (status = 'ok' AND novelty = 3) AS novelty_3,
    round(count(*) FILTER (status = 'ok' AND conceptual >= 2 AND novelty >= 2 AND well_formed >= 2)
          / count(*)::DOUBLE, 6) AS strong_rate
    FROM all_scores"""
oracle(
    "yield_report",
    f"SELECT source, false AS is_total, {_YIELD} GROUP BY source UNION ALL SELECT NULL, true, {_YIELD}",
    "scores", "all_scores",
)

# -- windows of rows -------------------------------------------------------------------------------

oracle(
    "natural_keys",
    """SELECT doc_id, 24::BIGINT AS key_chars, min(doc_id) OVER (PARTITION BY text) AS first_doc FROM documents""",
)
oracle(
    "block_sample",
    """WITH pages AS (SELECT doc_id, doc_id // 100 AS page, lang FROM documents),
         drawn AS (SELECT DISTINCT page, md5(page || '_42') AS h FROM pages ORDER BY h, page LIMIT 5)
       SELECT doc_id, page, lang FROM pages SEMI JOIN drawn USING (page)
       QUALIFY row_number() OVER (PARTITION BY page ORDER BY md5(doc_id || '_42'), doc_id) <= 20""",
)
oracle("sequential_scan", "SELECT doc_id, text FROM documents WHERE doc_id >= 37 AND doc_id < 187")
oracle(
    "trial_caps",
    f"""SELECT doc_id AS row_idx, 'files' AS cap FROM documents WHERE doc_id < {2 * fr.FILE_ROWS}
        UNION ALL (SELECT doc_id, 'rows' FROM documents ORDER BY doc_id LIMIT 30)""",
)
oracle(
    "first_hits",
    f"""SELECT doc_id, {_AXES} FROM ({_SCORED})
        WHERE conceptual >= 2 AND novelty >= 1 AND well_formed >= 1 ORDER BY doc_id LIMIT 10""",
)

_SCANNED = "documents WHERE doc_id BETWEEN 37 AND 736"
_CHOSEN = f"SELECT min(doc_id) FROM {_SCANNED} AND lang IN ('en', 'de') GROUP BY {key('text')}"
_HIT = "conceptual >= 2 AND novelty >= 1 AND well_formed >= 1"
oracle(
    "scan_and_classify",
    f"SELECT doc_id AS row_idx, status, {_AXES}, reasoning, {_HIT} AS is_hit FROM ({_SCORED}) WHERE doc_id IN ({_CHOSEN})",
)
oracle(
    "scan_and_classify_counters",
    f"""WITH chosen AS (SELECT * FROM ({_SCORED}) WHERE doc_id IN ({_CHOSEN})),
             again AS (SELECT count(*) AS n FROM documents WHERE doc_id BETWEEN 100 AND 159),
             other AS (SELECT count(*) AS n FROM {_SCANNED} AND lang NOT IN ('en', 'de')),
             spoken AS (SELECT count(*) AS n FROM {_SCANNED} AND lang IN ('en', 'de'))
        SELECT 'rows_seen' AS name, (SELECT count(*) FROM {_SCANNED}) + n AS value FROM again
        UNION ALL SELECT 'repeated_rows', n FROM again
        UNION ALL SELECT 'other_language', n FROM other
        UNION ALL SELECT 'duplicates', n - (SELECT count(*) FROM chosen) FROM spoken
        UNION ALL SELECT 'candidates', count(*) FROM chosen
        UNION ALL SELECT 'classified', count(*) FROM chosen
        UNION ALL SELECT 'failures', 0
        UNION ALL SELECT 'hits', count(*) FILTER ({_HIT}) FROM chosen
        UNION ALL SELECT 'input_tokens', coalesce(sum(input_tokens), 0)::BIGINT FROM chosen
        UNION ALL SELECT 'output_tokens', coalesce(sum(output_tokens), 0)::BIGINT FROM chosen""",
)

# -- streams: the same rows as the batch operators ---------------------------------------------

oracle("stream_prepare", f"SELECT DISTINCT {digest('text')} AS digest FROM documents")
oracle(
    "stream_prepare_exact",
    f"SELECT min(doc_id) AS doc_id, {digest('text')} AS digest FROM documents GROUP BY 2",
)
oracle(
    "stream_collect",
    f"""SELECT r.shard_id, r.custom_id, {_RANGED} AS status, conceptual, novelty, well_formed, m.source
        FROM results r LEFT JOIN manifests m USING (custom_id)""",
    *_READ, "manifests",
)
_ARRIVAL = "(shard_id >= '0004')::BIGINT"
oracle(
    "collect_progress",
    f"""SELECT {_ARRIVAL} AS bid, count(*) AS n_rows, count(*) FILTER (state = 'ok') AS ok,
               count(*) FILTER (state = 'refusal') AS refusal, count(*) FILTER (state NOT IN ('ok', 'refusal')) AS error
        FROM (SELECT shard_id, {_RANGED} AS state FROM results) GROUP BY 1""",
    *_READ,
)
oracle(
    "stream_watch",
    _STATUS_COUNTS.replace("FROM results", f"FROM (SELECT * REPLACE ({_RANGED} AS status) FROM results)"),
    *_READ,
)

ORACLES["stream_prepare_shards"] = ORACLES["prepare"]
