"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

from talklake.functions import markdown
from talklake.functions.terms import DOMAIN_STOP_WORDS, english_stop_words
from talklake.functions.text import SPACE

AS_OF = "TIMESTAMP '2026-03-01 06:30:00'"
BATCH = "batch-2026-03-01T06-30-00"
GENERATOR = "talklake v0.1.0"
FIRST_SECOND = "CAST(epoch(TIMESTAMP '2026-03-01') AS BIGINT)"
WATCH = "https://www.youtube.com/watch?v="


def words_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = words_list(english_stop_words())  # plain package data; a test compares it with Spark's list
DOMAIN = words_list(DOMAIN_STOP_WORDS)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+\z', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'))"


def letters(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({x}), 'https?://[^{SPACE}]+', '', 'g'), "
        "'[^a-z]+', ' ', 'g'))"
    )


def words(x: str) -> str:
    return f"list_filter(string_split({letters(x)}, ' '), lambda w: length(w) >= 2)"


def content_words(x: str) -> str:
    return f"list_filter({words(x)}, lambda w: NOT list_contains({STOP}, w))"


def pairs(t: str) -> str:
    return f"list_concat({t}, list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"


def enough_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SPACE}]+')) >= 10"


NOT_DOMAIN = f"len(list_filter(string_split(term, ' '), lambda w: NOT list_contains({DOMAIN}, w))) > 0"


def topics_of(source: str, key: str, text: str) -> str:
    """CTEs ending in ``ranked(key, term, tf, score, rank)``."""
    return f"""
    tok AS (SELECT {key}, {content_words(text)} AS t FROM {source} WHERE {enough_words(text)}),
    term_rows AS (SELECT {key}, unnest({pairs('t')}) AS term FROM tok),
    term_counts AS (SELECT {key}, term, count(*) AS tf FROM term_rows GROUP BY ALL),
    kept AS (SELECT * FROM term_counts
             QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY tf DESC, term) <= 30),
    scored AS (SELECT *, tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})) AS score FROM kept),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY tf DESC, term) AS rank
               FROM scored WHERE {NOT_DOMAIN} QUALIFY rank <= 10)"""


CHANNELS = """
    registry AS (
      SELECT source AS channel_id, 'Channel ' || source AS name,
             row_number() OVER (ORDER BY source) - 1 AS ord,
             coalesce(NOT (toxic * 5 > labelled), true) AS enabled,
             CASE WHEN labelled % 2 = 0 THEN 20 + n % 20 ELSE 30 END AS max_age_days,
             CASE WHEN toxic > 0 THEN 8 + toxic % 8 ELSE 5 END AS max_videos,
             CASE WHEN len(langs) > 3 THEN langs ELSE [] END AS tags
      FROM (SELECT source, coalesce(sum(toxic), 0) AS toxic, count(toxic) AS labelled, count(*) AS n,
                   list_sort(list(DISTINCT lang)) AS langs
            FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source))"""

LISTING = f"""
    entries AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position FROM documents),
    listed AS (
      SELECT source AS channel_id, position, doc_id, text, doc_id::VARCHAR AS video_id,
             CASE WHEN lang <> 'fr' THEN string_split(text, chr(10))[1] ELSE 'Unknown' END AS title,
             CASE WHEN lang = 'en' THEN 'Channel ' || source ELSE source END AS channel,
             CASE WHEN lang IN ('de', 'es') THEN {AS_OF}
                  ELSE (DATE '2026-03-01' - (n_chars % 60)::INTEGER)::TIMESTAMP END AS published,
             CASE WHEN lang = 'fr' THEN 'https://example.org/w/' ELSE '{WATCH}' END || doc_id AS url,
             CASE WHEN n_chars % 5 <> 0 THEN n_chars ELSE 0 END AS duration_seconds
      FROM entries WHERE n_chars % 13 <> 0 AND n_chars % 11 <> 0)"""

RECENT = f"""{CHANNELS}, {LISTING},
    recent AS (
      SELECT listed.*, ord FROM listed JOIN registry USING (channel_id)
      WHERE enabled AND position <= 2 * max_videos
        AND published >= {AS_OF} - to_days(max_age_days::INTEGER)
      QUALIFY row_number() OVER (PARTITION BY ord ORDER BY position) <= max_videos)"""

DETAILS = f"""
    details AS (
      SELECT page_id::VARCHAR AS video_id,
             coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'Unknown') AS title,
             regexp_extract(url, '^https?://([^/]+)', 1) AS channel,
             {AS_OF} AS published,
             CASE WHEN contains(url, '#') THEN '{WATCH}' || page_id ELSE url END AS url,
             length(html) AS duration_seconds,
             'About' || chr(10) || '0:00 Intro' || chr(10) || '1:30 '
               || regexp_extract(html, '<title>([^<]*)</title>', 1)
               || chr(10) || ' see 2:00 no' || chr(10) || '01:05:30 End' AS description,
             contains(url, '?') AS native
      FROM pages),
    detailed AS (
      SELECT l.channel_id, l.position, l.video_id, l.doc_id, l.text,
             CASE WHEN d.video_id IS NULL THEN l.title ELSE d.title END AS title,
             CASE WHEN d.video_id IS NULL THEN l.channel ELSE d.channel END AS channel,
             CASE WHEN d.video_id IS NULL THEN l.published ELSE d.published END AS published,
             CASE WHEN d.video_id IS NULL THEN l.url ELSE d.url END AS url,
             CASE WHEN d.video_id IS NULL THEN l.duration_seconds ELSE d.duration_seconds END AS duration_seconds,
             CASE WHEN d.video_id IS NULL THEN '' ELSE d.description END AS description,
             coalesce(native, false) AS native
      FROM listed l LEFT JOIN details d USING (video_id))"""

TRACKS = """
    tracks AS (
      SELECT doc_id, 'generated' AS track_id, lang, true AS is_generated FROM documents
      UNION ALL SELECT doc_id, 'manual', lang, false FROM documents JOIN labels USING (doc_id) WHERE quality = 1
      UNION ALL SELECT doc_id, 'english', 'en', true FROM documents WHERE n_chars > 2000),
    best AS (
      SELECT * FROM tracks WHERE lang IN ('en', 'fr')
      QUALIFY row_number() OVER (
        PARTITION BY doc_id ORDER BY is_generated, list_position(['en', 'fr'], lang), track_id) = 1)"""


def marked_up(line: str, seq: str) -> str:
    return (
        f"CASE {seq} % 3 WHEN 0 THEN '<i>' || {line} || '</i>' "
        f"WHEN 1 THEN {line} || ' [Music]' ELSE '  ' || {line} || ' ' END"
    )


LINES = f"""
    split_docs AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
    numbered_lines AS (SELECT doc_id, parts, unnest(range(0, len(parts))) AS seq FROM split_docs),
    lines AS (SELECT doc_id, seq, {marked_up('parts[seq + 1]', 'seq')} AS raw FROM numbered_lines)"""


def cleaned(source: str, key: str) -> str:
    """CTEs ending in ``unrepeated(key, seq, text)``."""
    tagless = "regexp_replace(raw, '<[^>]+>', '', 'g')"
    noteless = rf"regexp_replace({tagless}, '\[[^\]\n]*\]', '', 'g')"
    return f"""
    clean AS (SELECT {key}, seq, {strip(noteless)} AS text FROM {source}),
    filled AS (SELECT * FROM clean WHERE text <> ''),
    unrepeated AS (
      SELECT * FROM filled
      QUALIFY text IS DISTINCT FROM lag(text) OVER (PARTITION BY {key} ORDER BY seq))"""


def transcripts(key: str) -> str:
    return f"SELECT {key}::VARCHAR AS video_id, {squeeze('string_agg(text, chr(32) ORDER BY seq)')} AS transcript FROM unrepeated GROUP BY {key}"


MARK = rf"(?m)^(?:(\d{{1,2}}):)?(\d{{1,2}}):(\d{{2}})[{SPACE}]+(.+)$"


def clock(h: str, m: str, s: str) -> str:
    return (
        f"CASE WHEN {h} > 0 THEN printf('%d:%02d:%02d', {h}, {m}, {s}) "
        f"ELSE printf('%d:%02d', {m}, {s}) END"
    )


def text_marks(x: str) -> str:
    """A list of ``struct(stamp, title, seconds)`` from a description."""
    part = lambda g: f"regexp_extract_all({x}, '{MARK}', {g})[i]"
    h = f"coalesce(nullif({part(1)}, '')::BIGINT, 0)"
    m, s = f"{part(2)}::BIGINT", f"{part(3)}::BIGINT"
    return (
        f"list_transform(range(1, len(regexp_extract_all({x}, '{MARK}')) + 1), lambda i: "
        f"{{'stamp': {clock(h, m, s)}, 'title': {strip(part(4))}, 'seconds': ({h} * 3600 + {m} * 60 + {s})::DOUBLE}})"
    )


def native_mark(start: str, title: str) -> str:
    whole = f"floor({start})::BIGINT"
    stamp = clock(f"({whole} // 3600)", f"({whole} % 3600 // 60)", f"({whole} % 60)")
    return f"{{'stamp': {stamp}, 'title': coalesce({title}, 'Untitled'), 'seconds': {start}}}"


def marks_text(marks: str) -> str:
    return (
        f"array_to_string(list_transform({marks}, lambda c: c.stamp || '~' || c.title || '~' "
        "|| round(c.seconds * 100)::BIGINT::VARCHAR), '|')"
    )


DESCRIPTIONS = """
    ev AS (SELECT event_id, event_type, value, (props->>'$.k')::BIGINT AS k, floor(value)::BIGINT AS sec FROM events),
    described AS (
      SELECT event_id, event_type, value,
        'About' || chr(10) || (sec % 60) || ':' || lpad((k % 60)::VARCHAR, 2, '0') || ' Part ' || k || chr(10) ||
        CASE event_type
          WHEN 'error' THEN 'no chapters here'
          WHEN 'click' THEN ' 3:00 indented' || chr(10) || '99:99 odd ' || k
          WHEN 'view' THEN '2:00' || chr(10) || 'Next line'
          ELSE '01:' || lpad((k % 60)::VARCHAR, 2, '0') || ':30   ' || event_type || '  ' END AS description
      FROM ev)"""

EVENT_NATIVE = (
    "[" + native_mark("0.0::DOUBLE", "'Intro'") + ", "
    + native_mark("(value * 60)", "CASE WHEN event_type <> 'view' THEN event_type END") + "]"
)
HAS_NATIVE = "event_type IN ('purchase', 'view')"

POINT = "(('0x' || substring(sha256({x}), 1, 16))::UBIGINT % 9223372036854775808)::BIGINT"


def point(x: str) -> str:
    return POINT.format(x=x)


def store_row(number: str, batch: str) -> str:
    return f"""
      SELECT {point('doc_id::VARCHAR')} AS point_id, doc_id::VARCHAR AS video_id, 'Doc ' || doc_id AS title,
             source AS channel, '2026-03-01T06:30:00' AS published_date, '{WATCH}' || doc_id AS url,
             n_chars AS duration_seconds, substring(text, 1, 8000) AS transcript_text, lang AS topics,
             array_to_string(tags, '|') AS metadata_tags, ({number})::BIGINT AS transcript_number,
             {batch} AS batch_id, round(n_chars::FLOAT::DOUBLE, 6) AS first_value
      FROM documents d JOIN registry r ON r.channel_id = d.source
      WHERE lang <> 'de'"""


def double_list(x: str) -> str:
    return f"list_transform({x}, lambda v: v::DOUBLE)"


def cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}, {b})"


QUERIES = """
    places AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS place, embedding FROM embeddings),
    means AS (SELECT label, place, avg(embedding[place]::DOUBLE) AS x FROM places GROUP BY ALL),
    queries AS (SELECT label AS query_id, list(x ORDER BY place) AS q FROM means GROUP BY label)"""


def best_hits(k: int, where: str = "true") -> str:
    return f"""{QUERIES},
    hits AS (
      SELECT query_id, vec_id::VARCHAR AS video_id, vec_id, label,
             round({cosine(double_list('embedding'), 'q')}, 12) AS exact,
             row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, vec_id::VARCHAR) AS rank
      FROM embeddings, queries WHERE {where} QUALIFY rank <= {k})"""


#: The five nearest other vectors of every fiftieth one.
NEIGHBOURS = f"""
    WITH scored AS (
      SELECT a.vec_id AS query_id, b.vec_id::VARCHAR AS video_id,
             round({cosine(double_list('b.embedding'), double_list('a.embedding'))}, 12) AS exact
      FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
    SELECT query_id::BIGINT AS query_id, row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, video_id) AS rank,
           video_id, round(exact, 6) AS score
    FROM scored QUALIFY rank <= 5"""


# Planes, keys and candidates of the approximate search.
ANN = """
    plane AS (
      SELECT t, b, list_transform(range(64), lambda i:
        ('0x' || substring(md5(t || ':' || b || ':' || i), 1, 8))::UBIGINT / 2147483648.0::DOUBLE - 1) AS p
      FROM range(96) AS a(t), range(8) AS c(b)),
    row_keys AS (
      SELECT vec_id, t, sum(CASE WHEN list_dot_product(list_transform(embedding, lambda v: v::DOUBLE), p) > 0 THEN 1 << b ELSE 0 END) AS key
      FROM embeddings, plane GROUP BY ALL),
    query_keys AS (
      SELECT query_id, t, sum(CASE WHEN list_dot_product(q, p) > 0 THEN 1 << b ELSE 0 END) AS key FROM queries, plane GROUP BY ALL),
    shared AS (SELECT DISTINCT query_id, vec_id FROM row_keys JOIN query_keys USING (t, key)),
    near AS (
      SELECT query_id, vec_id::VARCHAR AS video_id,
             round(list_cosine_similarity(list_transform(embedding, lambda v: v::DOUBLE), q), 12) AS s,
             row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id::VARCHAR) AS rank
      FROM shared JOIN embeddings USING (vec_id) JOIN queries USING (query_id) QUALIFY rank <= 5)"""

PAYLOAD = (
    f"'Vector ' || vec_id AS title, 'Label ' || label AS channel, '2026-03-01T06:30:00' AS published_date, "
    f"'{WATCH}' || vec_id AS url, CASE WHEN label > 0 THEN [label::VARCHAR, 'vector'] ELSE [] END AS topics"
)


def hashed(source: str, key: str, text: str, name: str) -> str:
    """CTE ``name(key, place, w)``: the unit vector's parts as stored, in single precision."""
    return f"""
    {name}_words AS (SELECT {key}, unnest({words(text)}) AS word FROM {source}),
    {name}_counts AS (SELECT {key}, (('0x' || substring(md5(word), 1, 8))::UBIGINT % 64)::BIGINT AS place,
                     count(*) AS n FROM {name}_words GROUP BY ALL),
    {name} AS (SELECT {key}, place, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w FROM {name}_counts)"""


def slug(x: str) -> str:
    kept = rf"regexp_replace(lower({x}), '[^a-z0-9{SPACE}\-]', '', 'g')"
    dashed = rf"regexp_replace({kept}, '[{SPACE}]+', '-', 'g')"
    return f"substring(trim(regexp_replace({dashed}, '-+', '-', 'g'), '-'), 1, 50)"


def duration(x: str) -> str:
    return (
        f"CASE WHEN {x} <= 0 THEN 'Unknown' "
        f"WHEN {x} >= 3600 THEN printf('%dh %dm %ds', {x} // 3600, {x} % 3600 // 60, {x} % 60) "
        f"ELSE printf('%dm %ds', {x} // 60, {x} % 60) END"
    )


NUMBERED = f"""{CHANNELS}, {LISTING}, {DETAILS},
    numbered AS (
      SELECT detailed.*, row_number() OVER (ORDER BY ord, position) AS number
      FROM detailed JOIN registry USING (channel_id)),
    named AS (
      SELECT *, printf('TRANSCRIPT-%03d-%s.md', number, {slug('channel')}) AS filename FROM numbered)"""


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, values: dict[str, str]) -> str:
    """A template as a concatenation of literals and expressions."""
    pieces = [sql_text(template)]
    for name, expression in values.items():
        pieces = [
            part
            for piece in pieces
            for part in (
                f"'␞({expression})␞'".join(piece.split("{" + name + "}")).split("␞")
                if piece.startswith("'")
                else [piece]
            )
        ]
    return " || ".join(p for p in pieces if p != "''")


def topic_lines(list_expr: str) -> str:
    return (
        f"coalesce((SELECT string_agg('- ' || term, chr(10) ORDER BY rank) FROM {list_expr}), "
        f"{sql_text(markdown.NO_TOPICS)})"
    )


def chapter_lines(marks: str) -> str:
    return (
        f"CASE WHEN len({marks}) = 0 THEN {sql_text(markdown.NO_CHAPTERS)} ELSE "
        f"array_to_string(list_transform({marks}, lambda c: '- **' || c.stamp || '** — ' || c.title), chr(10)) END"
    )


DETAIL_MARKS = (
    "CASE WHEN native THEN ["
    + native_mark("0.0::DOUBLE", "'Start'")
    + ", "
    + native_mark("duration_seconds::DOUBLE", "NULL")
    + f"] ELSE {text_marks('description')} END"
)


def document(topics: str, text: str = "text") -> str:
    return filled(
        markdown.DOCUMENT,
        {
            "heading": "printf('TRANSCRIPT-%03d', number)",
            "title": "title",
            "date": "'2026-03-01'",
            "channel": "channel",
            "published": "strftime(published, '%Y-%m-%d')",
            "duration": duration("duration_seconds"),
            "url": "url",
            "video_id": "video_id",
            "batch_id": f"'{BATCH}'",
            "topics": topics,
            "chapters": chapter_lines("marks"),
            "transcript": text,
            "generator": sql_text(markdown.GENERATOR),
            "generated_at": "'2026-03-01T06:30:00'",
        },
    )


def rendered() -> str:
    """CTEs ending in ``rendered``: all listed documents as files."""
    return f"""{NUMBERED}, {topics_of('documents', 'doc_id', 'text')},
    topic_text AS (SELECT doc_id, string_agg('- ' || term, chr(10) ORDER BY rank) AS topic_list FROM ranked GROUP BY doc_id),
    marked AS (SELECT *, {DETAIL_MARKS} AS marks FROM named),
    rendered AS (
      SELECT '{BATCH}' AS batch_id, number, video_id, filename,
             {document(f"coalesce(topic_list, {sql_text(markdown.NO_TOPICS)})")} AS content
      FROM marked LEFT JOIN topic_text USING (doc_id))"""


# The manifest's texts, spelled out here as well.
def manifest(source: str, batch: str) -> str:
    nl = "chr(10)"
    generated = f"'Auto-generated by {GENERATOR}'"
    head = f"'## Transcript Batch: `' || {batch} || '`' || {nl} || {nl} || 'Auto-generated by **{GENERATOR}**.' || {nl} || {nl} || '### Files' || {nl}"
    tail = f"{nl} || {nl} || '---' || {nl} || '*Review and merge to add these transcripts to the document corpus.*'"
    message = (
        f"'docs(transcripts): add batch ' || {batch} || {nl} || {nl} || {generated} || {nl} || 'Files: ' || files || ' transcript(s)'"
    )
    return f"""
    counted AS (SELECT count(*) AS files FROM {source})
    SELECT {batch} AS batch_id, 'title' AS section, NULL AS filename, 'docs(transcripts): batch ' || {batch} AS text FROM counted
    UNION ALL SELECT {batch}, 'message', NULL, {message} FROM counted
    UNION ALL SELECT {batch}, 'body_head', NULL, {head} FROM counted
    UNION ALL SELECT {batch}, 'body_tail', NULL, {tail} FROM counted
    UNION ALL SELECT {batch}, 'file', filename, '- `' || filename || '`' FROM {source}"""


def run(stored: str, store: bool = True, failing: bool = True) -> str:
    """CTEs ending in ``judged``: what is stored, what was found, what became of it.

    ``store``: whether there is one; ``failing``: whether every seventh text's vector has the wrong size.
    """
    return f"""{CHANNELS}, {LISTING},
    placed AS (
      SELECT * REPLACE (2 * position - 1 AS position) FROM listed
      UNION ALL
      SELECT l.* REPLACE (n.channel_id AS channel_id, 2 * l.position AS position)
      FROM listed l JOIN registry r USING (channel_id) JOIN registry n ON n.ord = r.ord + 1 WHERE l.position <= 3),
    recent AS (
      SELECT placed.*, ord FROM placed JOIN registry USING (channel_id)
      WHERE enabled AND position <= 2 * max_videos
        AND published >= {AS_OF} - to_days(max_age_days::INTEGER)
      QUALIFY row_number() OVER (PARTITION BY ord ORDER BY position) <= max_videos),
    {TRACKS}, {LINES},
    track_lines AS (
      SELECT doc_id, seq, CASE WHEN track_id = 'manual' THEN '<b>' || raw || '</b>' ELSE raw END AS raw
      FROM lines JOIN best USING (doc_id)),
    {cleaned('track_lines', 'doc_id')},
    texts AS ({transcripts('doc_id')}),
    working AS (SELECT * FROM recent WHERE ord < (SELECT max(ord) FROM registry WHERE enabled)),
    flagged AS (
      SELECT working.*, transcript,
             EXISTS (SELECT 1 FROM labels b JOIN documents d USING (doc_id)
                     WHERE b.doc_id = working.doc_id AND quality = 0 {stored}) AS is_stored,
             EXISTS (SELECT 1 FROM labels b WHERE b.doc_id = working.doc_id AND toxic = 1) AS is_broken
      FROM working LEFT JOIN texts USING (video_id)),
    once AS (
      SELECT *, CASE WHEN is_stored THEN 'already_processed' WHEN is_broken THEN 'transcript_error'
                     WHEN coalesce(transcript, '') = '' THEN 'no_transcript'
                     WHEN {str(store and failing).lower()} AND length(transcript) % 7 = 0 THEN 'store_failed'
                     ELSE 'processed' END AS first_status,
             row_number() OVER (PARTITION BY doc_id ORDER BY ord, position) AS turn
      FROM flagged),
    judged AS (
      SELECT *, CASE WHEN {str(store).lower()} AND turn > 1 AND first_status = 'processed' THEN 'already_processed'
                     ELSE first_status END AS status
      FROM once)"""


# German documents have vectors of the wrong size, so the store never took them.
BATCH_RUN = run("AND d.lang <> 'de'")
STREAM_RUN = run("AND false", failing=False)
STORELESS_RUN = run("AND false", store=False)

OUTCOMES = f"""
    outcomes AS (
      SELECT channel_id, position, video_id, status FROM judged
      UNION ALL
      SELECT channel_id, NULL, NULL, 'channel_failed' FROM registry
      WHERE enabled AND ord = (SELECT max(ord) FROM registry WHERE enabled))"""


def run_documents() -> str:
    """CTEs ending in ``run_numbered``: processed videos with details and numbers."""
    return f"""{DETAILS.replace('FROM listed l', 'FROM judged l').replace(
        'l.text,', 'l.transcript, l.ord, l.status,')},
    run_numbered AS (
      SELECT *, row_number() OVER (ORDER BY ord, position) AS number FROM detailed WHERE status IN ('processed', 'store_failed'))"""


def all_sql() -> dict[str, str]:
    return {
        "doc_topics": f"""WITH {topics_of('documents', 'doc_id', 'text')}
            SELECT doc_id, coalesce(string_agg(term, '|' ORDER BY rank), '') AS topics, count(term) AS n_topics
            FROM documents LEFT JOIN ranked USING (doc_id) GROUP BY doc_id""",
        "topic_scores": f"""WITH {topics_of('documents', 'doc_id', 'text')}
            SELECT doc_id, rank, term, tf, round(score, 6) AS score FROM ranked""",
        "topics_sentence": f"""WITH parts AS (
              SELECT doc_id, list_filter(regexp_split_to_array(text, '[.\\n]'), lambda s: {squeeze('s')} <> '') AS ss
              FROM documents WHERE {enough_words('text')}),
            sentences AS (SELECT doc_id, len(ss) AS n, unnest(range(0, len(ss))) AS pos, ss FROM parts),
            tok AS (SELECT doc_id, n, pos, {content_words('ss[pos + 1]')} AS t FROM sentences),
            term_rows AS (SELECT doc_id, n, pos, unnest({pairs('t')}) AS term FROM tok),
            counts AS (SELECT doc_id, n, pos, term, count(*) AS tf FROM term_rows GROUP BY ALL),
            per_term AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS df, sum(tf) AS total FROM counts GROUP BY ALL),
            vocabulary AS (
              SELECT * FROM per_term WHERE n <= 5 OR df <= n * 0.95
              QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, term) <= 30),
            weighted AS (
              SELECT c.doc_id, c.pos, c.term, c.tf * (ln((1 + v.n) / (1 + v.df)) + 1) AS w
              FROM counts c JOIN vocabulary v ON c.doc_id = v.doc_id AND c.term = v.term),
            shares AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, pos)) AS share FROM weighted),
            scores AS (SELECT doc_id, term, round(sum(share), 12) AS s FROM shares WHERE {NOT_DOMAIN} GROUP BY ALL)
            SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, term) AS rank, term,
                   round(s, 6) AS score FROM scores QUALIFY rank <= 10""",
        "recent_per_channel": f"""WITH {RECENT}
            SELECT channel_id, position, video_id, title, channel,
                   strftime(published, '%Y-%m-%dT%H:%M:%S') AS published, url, duration_seconds FROM recent""",
        "recent_counts": f"""WITH {RECENT}
            SELECT channel_id, count(*) AS video_count FROM recent GROUP BY channel_id""",
        "unprocessed": f"""WITH {RECENT}
            SELECT ord, position, video_id, '[DRY RUN] Would process: ' || title || ' (' || video_id || ')' AS line
            FROM recent WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""",
        "young_orders": """SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
            WHERE o_orderdate >= TIMESTAMP '2001-08-01 12:00:00'
              - CASE WHEN o_orderstatus = 'O' THEN INTERVAL 90 DAY ELSE INTERVAL 30 DAY END""",
        "details_fallback": f"""WITH {LISTING}, {DETAILS}
            SELECT video_id, title, channel, strftime(published, '%Y-%m-%d') AS published, url, duration_seconds,
                   description, CASE WHEN native THEN 2 ELSE 0 END::BIGINT AS n_chapters FROM detailed""",
        "video_tags": f"""WITH {CHANNELS}, {LISTING}
            SELECT video_id, array_to_string(tags, '|') AS tags FROM listed JOIN registry USING (channel_id)""",
        "best_track": f"""WITH {TRACKS} SELECT doc_id::VARCHAR AS video_id, track_id, is_generated FROM best""",
        "clean_segments": f"""WITH {LINES}, {cleaned('lines', 'doc_id')}
            SELECT doc_id::VARCHAR AS video_id, seq, text FROM unrepeated""",
        "transcript_text": f"""WITH {TRACKS}, {LINES},
            track_lines AS (
              SELECT doc_id, seq, CASE WHEN track_id = 'manual' THEN '<b>' || raw || '</b>' ELSE raw END AS raw
              FROM lines JOIN best USING (doc_id)),
            {cleaned('track_lines', 'doc_id')} {transcripts('doc_id')}""",
        "conversation_text": f"""WITH turns AS (
              SELECT conv_id, turn AS seq, {marked_up('text', 'turn')} AS raw FROM conversations),
            {cleaned('turns', 'conv_id')} {transcripts('conv_id')}""",
        "page_text_strip": f"""SELECT page_id, {squeeze("regexp_replace(html, '<[^>]+>', '', 'g')")} AS text FROM pages""",
        "chapters_from_text": f"""WITH {DESCRIPTIONS}
            SELECT event_id, {marks_text(text_marks('description'))} AS chapters FROM described""",
        "chapters_native": f"""WITH {DESCRIPTIONS}
            SELECT event_id, CASE WHEN {HAS_NATIVE} THEN {marks_text(EVENT_NATIVE)} ELSE '' END AS chapters FROM described""",
        "chapters_pick": f"""WITH {DESCRIPTIONS}
            SELECT event_id, CASE WHEN {HAS_NATIVE} THEN {marks_text(EVENT_NATIVE)}
                   ELSE {marks_text(text_marks('description'))} END AS chapters FROM described""",
        "point_ids": f"""SELECT doc_id, {point('doc_id::VARCHAR')} AS point_id, {point('doc_id::VARCHAR')} % 64 AS bucket
            FROM documents""",
        "store_upsert": f"""WITH {CHANNELS} {store_row("doc_id + 3", "'batch-new'")}""",
        "store_insert": f"""WITH {CHANNELS}, old AS (SELECT doc_id FROM labels WHERE quality = 0)
            {store_row("CASE WHEN doc_id IN (FROM old) THEN 1 ELSE doc_id + 2 END",
                       "CASE WHEN doc_id IN (FROM old) THEN 'batch-old' ELSE 'batch-new' END")}""",
        "last_writes": """SELECT conv_id, turn, role, text FROM conversations
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
        "search_topk": f"""WITH {best_hits(5)}
            SELECT query_id::BIGINT AS query_id, rank, video_id, round(exact, 6) AS score FROM hits""",
        "search_rows": NEIGHBOURS,
        "search_pruned": NEIGHBOURS,
        "search_topk_filtered": f"""WITH {best_hits(7, 'label <> 3')}
            SELECT query_id::BIGINT AS query_id, rank, video_id, round(exact, 6) AS score FROM hits""",
        "search_json": f"""WITH {best_hits(5)}, shown AS (
              SELECT query_id, rank, video_id, {PAYLOAD}, round(exact, 4) AS score FROM hits)
            SELECT query_id::BIGINT AS query_id, rank, to_json({{'video_id': video_id, 'title': title, 'channel': channel,
              'published_date': published_date, 'url': url, 'topics': topics, 'score': score}})::VARCHAR AS json FROM shown""",
        "search_text": f"""WITH {best_hits(5)}, shown AS (
              SELECT query_id, rank, printf('%d. [%.3f] %s', rank, exact, title) || chr(10) || '   Channel: ' || channel
                || chr(10) || '   Date: ' || published_date || chr(10) || '   URL: ' || url || chr(10)
                || '   Topics: ' || array_to_string(topics, ', ') AS text
              FROM (SELECT query_id, rank, exact, {PAYLOAD} FROM hits))
            SELECT query_id::BIGINT AS query_id, rank, text FROM shown
            UNION ALL SELECT -1, 0, 'No results found.'""",
        "search_nearest": f"""WITH asked AS (SELECT list_transform(range(64), lambda i: ((7 * i) % 11 - 5) / 5.0::DOUBLE) AS q)
            SELECT vec_id::VARCHAR AS video_id, 'Vector ' || vec_id AS title, 'Label ' || label AS channel,
                   round({cosine(double_list('embedding'), 'q')}, 6) AS score
            FROM embeddings, asked
            ORDER BY round({cosine(double_list('embedding'), 'q')}, 12) DESC, vec_id::VARCHAR LIMIT 5""",
        "search_ann": f"""WITH {QUERIES}, {ANN}
            SELECT query_id::BIGINT AS query_id, rank, video_id, round(s, 6) AS score FROM near""",
        "search_ann_recall": f"""WITH {best_hits(5)}, {ANN},
            pairs AS (SELECT query_id, count(*) AS scored FROM shared GROUP BY query_id),
            judged AS (
              SELECT query_id, count(*) AS exact, count(near.video_id) AS found
              FROM hits LEFT JOIN near USING (query_id, video_id) GROUP BY query_id)
            SELECT query_id::BIGINT AS query_id, exact, found, found / exact AS recall,
                   round(coalesce(scored, 0) / (SELECT count(*) FROM embeddings), 6) AS scored_share
            FROM judged LEFT JOIN pairs USING (query_id)""",
        "embed_model": """SELECT doc_id, length(text) AS chars, length(text) - length(replace(text, chr(10), '')) AS breaks,
                   strlen(text) - length(text) AS wide_bytes FROM documents""",
        "validate_report": f"""WITH {CHANNELS}
            SELECT 0 AS section, ord, '    - ' || name || ' (' || channel_id || ') [' || CASE WHEN enabled THEN 'enabled' ELSE 'disabled' END
                   || ']' AS line FROM registry
            UNION ALL SELECT 0, -1, '  Channels: ' || count(*) || ' configured' FROM registry
            UNION ALL SELECT 1, 0, '  Store: OK (64 dimensions)'
            UNION ALL SELECT 2, 0, '  Store: FAILED (PATH_NOT_FOUND)'""",
        "store_rejected": f"""WITH {CHANNELS} SELECT doc_id::VARCHAR AS video_id, 'batch-new' AS batch_id, 1 AS vector_size
            FROM documents WHERE lang = 'de'""",
        "store_compacted": """SELECT doc_id::VARCHAR AS video_id, doc_id + 1 AS transcript_number, 'batch-two' AS batch_id,
                   true AS compacted FROM documents WHERE lang <> 'de'""",
        "outcomes_without_store": f"""WITH {STORELESS_RUN}, {OUTCOMES}
            SELECT '{BATCH}' AS batch_id, channel_id, position, video_id, status FROM outcomes""",
        "embed_hash": f"""WITH {hashed('documents', 'doc_id', 'text', 'vec')}
            SELECT doc_id, place, round(w, 6) AS weight FROM vec""",
        "doc_search": f"""WITH {hashed('documents', 'doc_id', 'text', 'vec')}, {hashed('benchmark', 'item_id', 'text', 'ask')},
            norms AS (SELECT doc_id, sqrt(sum(w * w)) AS dn FROM vec GROUP BY doc_id),
            ask_norms AS (SELECT item_id, sqrt(sum(w * w)) AS qn FROM ask GROUP BY item_id),
            dots AS (SELECT item_id, doc_id, sum(v.w * a.w) AS dot FROM vec v JOIN ask a USING (place) GROUP BY ALL),
            hits AS (
              SELECT item_id, doc_id, round(dot / (dn * qn), 12) AS s,
                     row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id::VARCHAR) AS rank
              FROM dots JOIN norms USING (doc_id) JOIN ask_norms USING (item_id) QUALIFY rank <= 5)
            SELECT item_id AS query_id, rank, source AS channel, round(s, 5) AS score, doc_id::VARCHAR AS video_id
            FROM hits JOIN documents USING (doc_id)""",
        "rendered_docs": f"WITH {rendered()} SELECT * FROM rendered",
        "file_names": f"""WITH {NUMBERED}
            SELECT '{BATCH}' AS batch_id, video_id, number, filename, {duration('duration_seconds')} AS duration FROM named""",
        "slugs": f"""SELECT page_id, {slug('url')} AS url_slug, {slug('html')} AS html_slug FROM pages""",
        "rendered_roundtrip": f"WITH {rendered()} SELECT filename, content FROM rendered",
        "rendered_published": f"WITH {rendered()} SELECT '{BATCH}' AS batch, filename, content FROM rendered",
        "batch_manifest": f"WITH {NUMBERED}, {manifest('named', sql_text(BATCH))}",
        "push_manifest": f"""WITH {NUMBERED}, pushed AS (
              SELECT filename FROM named UNION ALL SELECT 'TRANSCRIPT-notes.md'), {manifest('pushed', "'batch-push'")}""",
        "registry_report": f"""WITH {CHANNELS}
            SELECT ord, '    - ' || name || ' (' || channel_id || ') [' || CASE WHEN enabled THEN 'enabled' ELSE 'disabled' END
                   || ']' AS line FROM registry
            UNION ALL SELECT -1, '  Channels: ' || count(*) || ' configured' FROM registry""",
        "listing_urls": """WITH names AS (
              SELECT source AS name FROM documents UNION SELECT regexp_extract(url, '^https?://([^/.]+)', 1) FROM pages),
            forms AS (SELECT unnest(['UC' || name, '@' || name, name]) AS channel_id FROM names)
            SELECT channel_id, 'https://www.youtube.com/' || CASE WHEN channel_id[1:2] = 'UC' THEN 'channel/' ELSE '' END
                   || channel_id || '/videos' AS url FROM forms""",
        "ingest_outcomes": f"""WITH {BATCH_RUN}, {OUTCOMES}
            SELECT '{BATCH}' AS batch_id, channel_id, position, video_id, status FROM outcomes""",
        "run_summary": f"""WITH {BATCH_RUN}, {OUTCOMES}
            SELECT '{BATCH}' AS batch_id, count(*) FILTER (status IN ('processed', 'store_failed')) AS processed, count(*) AS candidates
            FROM outcomes""",
        "run_counts": f"""WITH {BATCH_RUN}, {OUTCOMES},
            statuses AS (SELECT unnest(['channel_failed', 'already_processed', 'transcript_error', 'no_transcript',
                                        'store_failed', 'processed']) AS status)
            SELECT '{BATCH}' AS batch_id, s.status, count(o.status) AS n
            FROM statuses s LEFT JOIN outcomes o USING (status) GROUP BY s.status""",
        "ingest_documents": f"""WITH {BATCH_RUN}, {run_documents()},
            {topics_of("run_numbered", "doc_id", "transcript")},
            topic_text AS (SELECT doc_id, string_agg('- ' || term, chr(10) ORDER BY rank) AS topic_list FROM ranked GROUP BY doc_id),
            marked AS (SELECT *, {DETAIL_MARKS} AS marks FROM run_numbered)
            SELECT '{BATCH}' AS batch_id, number, video_id,
                   printf('TRANSCRIPT-%03d-%s.md', number, {slug('channel')}) AS filename,
                   {document(f"coalesce(topic_list, {sql_text(markdown.NO_TOPICS)})", "transcript")} AS content
            FROM marked LEFT JOIN topic_text USING (doc_id)""",
        "stream_ingest": f"""WITH {STREAM_RUN}, {run_documents()}
            SELECT video_id, title, channel, number AS transcript_number, '{BATCH}' AS batch_id,
                   substring(transcript, 1, 8000) AS transcript_text FROM run_numbered""",
        # Two days are remembered in full; after the third run's entries all of that has expired.
        "stream_ingest_bounded": f"""WITH v AS (
              SELECT doc_id AS d, {FIRST_SECOND} + doc_id % 86400 AS s FROM documents
              WHERE (n_chars % 13 = 0) IS NOT TRUE AND (n_chars % 11 = 0) IS NOT TRUE),
            runs AS (
              SELECT 1 AS run, count(*) FILTER (d % 3 <> 0) AS state_rows, 0 AS expired, 0 AS late FROM v
              UNION ALL SELECT 2, count(*), 0, 0 FROM v
              UNION ALL SELECT 3, 0, count(*), 0 FROM v
              UNION ALL SELECT 4, count(*) FILTER (d % 2 = 0), 0, count(*) FILTER (d % 2 <> 0) FROM v),
            fresh AS (
              SELECT 1 AS run, d, s FROM v WHERE d % 3 <> 0
              UNION ALL SELECT 2, d, s + 86400 FROM v WHERE d % 3 = 0
              UNION ALL SELECT 4, d, s + 864000 FROM v WHERE d % 2 = 0)
            SELECT runs.run::BIGINT AS run, state_rows::BIGINT AS state_rows, expired::BIGINT AS expired,
                   late::BIGINT AS late, CAST(d AS VARCHAR) AS video_id, s::BIGINT AS seen_second
            FROM runs LEFT JOIN fresh USING (run)""",
        # A number counts a lane's videos: one of 64 lanes of each channel, by the id.
        "stream_numbers": f"""WITH {LISTING}, v AS (
              SELECT channel_id, position, video_id, doc_id AS d, {FIRST_SECOND} + doc_id % 86400 AS s,
                     {point('video_id')} % 64 AS lane FROM listed),
            fresh AS (
              SELECT 1 AS run, * FROM v WHERE d % 3 <> 0
              UNION ALL SELECT 2, * REPLACE (s + 86400 AS s) FROM v WHERE d % 3 = 0
              UNION ALL SELECT 4, * REPLACE (s + 864000 AS s) FROM v WHERE d % 2 = 0)
            SELECT run::BIGINT AS run, channel_id, video_id, s::BIGINT AS seen_second,
                   ((row_number() OVER (PARTITION BY channel_id, lane ORDER BY run, s, position, video_id) - 1) * 64
                    + lane + 1)::BIGINT AS number
            FROM fresh""",
        "dump_outcomes": f"""WITH {STORELESS_RUN}, {OUTCOMES}
            SELECT '{BATCH}' AS batch_id, channel_id, position, video_id, status FROM outcomes""",
        "dump_stream": f"""WITH {LISTING}
            SELECT channel_id, position, video_id, title, channel, strftime(published, '%Y-%m-%dT%H:%M:%S') AS published,
                   url, duration_seconds FROM listed""",
    }
