"""DuckDB twins of the registered queries, composed from shared CTEs."""

from __future__ import annotations

from wordtide.sources.stopwords import COMMON

# Separators as RE2 classes, links with a Unicode-aware word end (\1 puts
# the character after it back), escapes, numbers.
BASIC = r"""[\s\n,;.:?!''’"/\\]"""
EVENT = r"""[\s\n,;.:?!''’"{}\[\]()/\\]"""
LINK = (
    r"(?:(?:https?:(?://|\\/\\/).)?(?:www\.)?[-a-zA-Z0-9@:%._+~#=]{2,256}\.[a-z]{2,6}"
    r"(?:[-@:%+.~#?&/\\=][-a-zA-Z0-9@:%_+.~#?&/\\=]*|([^\p{L}\p{N}_]|$)))"
    r"|(?:https:\\/\\/t\.co\\/[-a-zA-Z0-9@:%._+~#=]{1,256})"
)
ESCAPE = r"\\u\w\w\w\w"
NUMBER = r"-?\d+(\.\d+)?"

STOP = ", ".join(f"('{w}')" for w in COMMON)
PERIODS = {"morning": 1, "afternoon": 2, "evening": 3, "night": 0}
LAST_DAY = "DATE '2024-01-07'"

CTES = {
    "posts": """
        SELECT doc_id AS post_id,
               TIMESTAMP '2024-01-01 00:00:00' + to_seconds((doc_id * 7919) % 604800) AS ts,
               lang, text
        FROM documents""",
    "timed": """
        SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(ts AS DATE) AS day FROM posts""",
    "stop": f"SELECT DISTINCT word FROM (VALUES {STOP}) AS s(word)",
    "basic": f"""
        SELECT * FROM (
            SELECT post_id, ts, sec, day, unnest(regexp_split_to_array(lower(text), '{BASIC}')) AS word
            FROM timed)
        WHERE word <> ''""",
    "normalized": f"""
        SELECT * FROM (
            SELECT post_id, ts, sec, day,
                   unnest(regexp_split_to_array(
                       regexp_replace(regexp_replace(regexp_replace(
                           lower(text), '{LINK}', '\\1', 'g'), '{ESCAPE}', '', 'g'),
                           'https|co|rt', '', 'g'),
                       '{EVENT}')) AS word
            FROM timed)
        WHERE word <> '' AND word NOT IN (SELECT word FROM stop)
          AND NOT regexp_full_match(word, '{NUMBER}')""",
    "live": """
        SELECT post_id, sec, unnest(string_split(rtrim(replace(text, chr(10), ' '), ' '), ' ')) AS word
        FROM timed
        WHERE text = '' OR rtrim(replace(text, chr(10), ' '), ' ') <> ''""",
    "quartered": """
        SELECT *, CAST((sec % 86400) // 21600 AS INTEGER) AS quarter FROM basic
        WHERE (sec % 86400) % 21600 <> 0 AND sec % 86400 <> 86399""",
    "word_counts": """
        SELECT day, quarter, word, count(*) AS count FROM quartered
        GROUP BY day, quarter, word HAVING count(*) > {min_count}""",
    "totals": """
        SELECT day, CAST((sec % 86400) // 21600 AS INTEGER) AS quarter, count(*) AS n_posts
        FROM timed WHERE (sec % 86400) % 21600 <> 0 AND sec % 86400 <> 86399
        GROUP BY ALL""",
    "frequency": """
        SELECT c.day, c.quarter, c.word, round(c.count / t.n_posts, 4) AS freq
        FROM word_counts c JOIN totals t ON c.day = t.day AND c.quarter = t.quarter
        WHERE c.word NOT IN (SELECT word FROM stop)""",
    # The literal form: one join per quarter.
    "history": """
        SELECT n.day, n.word, m.freq AS f_morning, a.freq AS f_afternoon, e.freq AS f_evening,
               n.freq AS f_night, (n.freq + m.freq + a.freq + e.freq) / 4 AS mean
        FROM (SELECT * FROM frequency WHERE quarter = 0) n
        JOIN (SELECT * FROM frequency WHERE quarter = 1) m ON m.day = n.day AND m.word = n.word
        JOIN (SELECT * FROM frequency WHERE quarter = 2) a ON a.day = n.day AND a.word = n.word
        JOIN (SELECT * FROM frequency WHERE quarter = 3) e ON e.day = n.day AND e.word = n.word""",
    "deviation": "SELECT day, word, "
    + ", ".join(
        f"CASE WHEN mean = 0 THEN NULL ELSE round((f_{p} - mean) / mean * 100) END AS d_{p}"
        for p in PERIODS
    )
    + " FROM history",
    "mean_deviation": "SELECT word, "
    + ", ".join(
        f"CASE WHEN count(d_{p}) = 7 THEN sum(d_{p}) / 7 END AS d_{p}" for p in PERIODS
    )
    + " FROM deviation GROUP BY word HAVING count(*) = 7",
    "seasonal": "SELECT * FROM mean_deviation WHERE "
    + " OR ".join(f"d_{p} > 20" for p in PERIODS),
    "fixed_counts": """
        SELECT sec // 3600 AS batch_idx, word, count(*) AS n_now FROM normalized GROUP BY ALL""",
    "live_counts": "SELECT sec // 120 AS batch_idx, word, count(*) AS n_now FROM live GROUP BY ALL",
    "seconds": "SELECT DISTINCT day, sec FROM timed",
    "event_seconds": """
        SELECT DISTINCT CAST(ts AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS sec
        FROM events""",
    "month_seconds": """
        SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS sec
        FROM events""",
    "anchors": """
        SELECT day, 0 AS batch_idx, min(sec) AS anchor_sec FROM {seconds} GROUP BY day
        UNION ALL
        SELECT a.day, a.batch_idx + 1, min(s.sec)
        FROM anchors a JOIN {seconds} s ON s.day = a.day AND s.sec > a.anchor_sec + 3600
        GROUP BY a.day, a.batch_idx""",
    "replayed": """
        SELECT t.day, t.word, a.batch_idx
        FROM normalized t ASOF JOIN anchors a ON t.day = a.day AND t.sec >= a.anchor_sec""",
    "replay_counts": """
        SELECT day, batch_idx, word, count(*) AS n_now FROM replayed GROUP BY ALL""",
    "hourly": """
        SELECT day, word, CAST((sec % 86400) // 3600 AS INTEGER) AS batch_idx FROM normalized""",
    "versus_history": f"""
        SELECT *, n_past / 6 AS avg_past FROM (
            SELECT batch_idx, word, count(*) FILTER (WHERE day = {LAST_DAY}) AS n_now,
                   count(*) FILTER (WHERE day <> {LAST_DAY}) AS n_past
            FROM {{placed}} GROUP BY batch_idx, word)
        WHERE n_now > 0 AND n_past > 0""",
    "kept": """
        SELECT post_id,
               list_filter(regexp_split_to_array(lower(text), '"""
    + BASIC
    + """'), lambda w: NOT list_contains([{stop_list}], w)) AS words
        FROM posts WHERE ts > TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-08'""",
    "vocabulary": """
        SELECT CAST(row_number() OVER (ORDER BY count DESC, term) - 1 AS INTEGER) AS term_idx,
               term, count
        FROM (SELECT term, count(*) AS count FROM (SELECT unnest(words) AS term FROM kept)
              GROUP BY term ORDER BY count DESC, term LIMIT 1000)""",
}


def _past(counts: str, n: int, stream: str = "") -> str:
    """Counts with those of the n-1 batches before."""
    return f"""
        SELECT *, n_past / {n - 1} AS avg_past FROM (
            SELECT *, CAST(coalesce(sum(n_now) OVER (
                PARTITION BY {stream} word ORDER BY batch_idx
                RANGE BETWEEN {n - 1} PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS n_past
            FROM {counts})"""


def _interval(joined: str, samples: int) -> dict[str, str]:
    """CTEs ending in `ci(total, ci)`: chi-squared quantiles by Newton steps.

    For 2m degrees the distribution is one minus a Poisson sum of m terms.
    """
    start = f"""
        SELECT total, side, m, p,
               m * greatest(1 - 1 / (9 * m) + z * sqrt(1 / (9 * m)), 0.01) ** 3 AS y
        FROM (SELECT DISTINCT n_past AS total FROM {joined}),
             (VALUES ('low', 0, 0.005, -2.5758293035489004),
                     ('high', 1, 0.995, 2.5758293035489004)) AS v(side, extra, p, z),
             LATERAL (SELECT CAST(greatest(total, 1) * {samples} + extra AS DOUBLE) AS m)"""
    ctes = {"step0 AS MATERIALIZED": start}
    for i in range(8):
        ctes[f"step{i + 1} AS MATERIALIZED"] = f"""
        SELECT total, side, m, p, greatest(y / 10, y - (1 - p - list_sum(list_transform(
            range(CAST(m AS BIGINT)), lambda j: exp(j * ln(y) - y - lgamma(j + 1)))))
            / exp((m - 1) * ln(y) - y - lgamma(m))) AS y
        FROM step{i}"""
    ctes["ci"] = f"""
        SELECT total, sum(CASE WHEN side = 'high' THEN y ELSE -y END) / {samples} AS ci
        FROM step8 GROUP BY total"""
    return ctes


NEEDS = {
    "timed": ["posts"],
    "basic": ["timed"],
    "normalized": ["timed", "stop"],
    "live": ["timed"],
    "quartered": ["basic"],
    "word_counts": ["quartered"],
    "totals": ["timed"],
    "frequency": ["word_counts", "totals", "stop"],
    "history": ["frequency"],
    "deviation": ["history"],
    "mean_deviation": ["deviation"],
    "seasonal": ["mean_deviation"],
    "fixed_counts": ["normalized"],
    "live_counts": ["live"],
    "seconds": ["timed"],
    "replayed": ["normalized", "anchors"],
    "replay_counts": ["replayed"],
    "hourly": ["normalized"],
    "kept": ["posts"],
    "vocabulary": ["kept"],
}


def _query(select: str, *needed: str, extra: dict[str, str] | None = None, **values) -> str:
    """`select` below the CTEs it needs, in order of dependence."""
    stop_list = ", ".join(f"'{w}'" for w in COMMON)
    values = {"stop_list": stop_list, "min_count": 10, "seconds": "seconds", "placed": "replayed", **values}
    needs = {**NEEDS, "anchors": [values["seconds"]], "versus_history": [values["placed"]]}
    if values["seconds"] != "seconds":
        needs[values["seconds"]] = []
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in needs.get(name, []):
                visit(other)
            ordered.append(name)

    for name in needed:
        visit(name)
    bodies = []
    for name in ordered:
        body = CTES[name]
        for key, value in values.items():
            body = body.replace("{" + key + "}", str(value))
        bodies.append(f"{name} AS ({body})")
    for name, body in (extra or {}).items():
        head = name if " AS " in name else f"{name} AS"
        bodies.append(f"{head} ({body})")
    return f"WITH RECURSIVE {', '.join(bodies)} {select}"


def _marked(warmup: str | None) -> str:
    return f", {warmup} AS is_warmup" if warmup else ""


def _root(joined: str, eta: int, *columns: str, warmup: str | None = None) -> str:
    shown = ", ".join([*columns, "batch_idx", "word", "n_now", "avg_past"])
    margin = f"({abs(eta)} * sqrt(avg_past + 10) + 20)"
    return f"SELECT {shown}, {margin} AS margin{_marked(warmup)} FROM {joined} WHERE n_now > {margin} + avg_past"


def _poisson(joined: str, eta: int, *columns: str, warmup: str | None = None) -> str:
    shown = ", ".join([*columns, "batch_idx", "word", "n_now", "avg_past"])
    return f"""SELECT {shown}, round({eta} * ci, 4) AS margin{_marked(warmup)}
        FROM {joined} JOIN ci ON ci.total = n_past WHERE n_now > {eta} * ci + avg_past"""


def oracle_sql() -> dict[str, str]:
    found = _oracle_sql()
    # The same rows from a stream.
    return found | {"stream_replay_batches": found["replay_batches_by_month"]}


def _oracle_sql() -> dict[str, str]:
    past5 = {"past": _past("fixed_counts", 5)}
    replay = {"past": _past("replay_counts", 2, "day,")}
    live = {"past": _past("live_counts", 5)}
    history = "SELECT * FROM versus_history"
    post_sums = _query(
        """SELECT post_id, CAST(10 AS INTEGER) AS n_topics,
               CASE WHEN list_has_any(words, (SELECT list(term) FROM vocabulary)) THEN 1.0::DOUBLE
                    ELSE 0.0::DOUBLE END AS total
        FROM kept""",
        "kept",
        "vocabulary",
    )
    return {
        "posts": _query("SELECT * FROM posts", "posts"),
        "event_time_parse": _query(
            """SELECT post_id, created_at,
                   strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') AS ts
            FROM (SELECT post_id, strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at
                  FROM posts)""",
            "posts",
        ),
        "stopwords": _query(
            """SELECT s.word, count(DISTINCT b.post_id) AS n_posts
            FROM stop s LEFT JOIN basic b ON b.word = s.word GROUP BY s.word""",
            "stop",
            "basic",
        ),
        "history_days": _query(
            f"SELECT day, count(*) AS n_posts FROM timed WHERE day <> {LAST_DAY} GROUP BY day",
            "timed",
        ),
        "time_range_filter": """
            SELECT event_id AS post_id, ts, event_type AS text FROM events
            WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-03 10:00:00'
              AND date_trunc('second', ts) < TIMESTAMP '2024-01-17 18:00:00'""",
        "tokens_basic": _query("SELECT post_id, word FROM basic", "basic"),
        "tokens_live": _query("SELECT post_id, word FROM live", "live"),
        "normalized_tokens": _query("SELECT post_id, word FROM normalized", "normalized"),
        "word_counts": _query("SELECT * FROM word_counts", "word_counts"),
        "period_totals": _query("SELECT * FROM totals", "totals"),
        "word_frequency": _query("SELECT * FROM frequency", "frequency"),
        "week_word_frequency": _query(
            """SELECT word, round(count(*) / (
                   SELECT count(*) FROM timed WHERE ts > TIMESTAMP '2024-01-01'), 4) AS freq
            FROM basic
            WHERE ts > TIMESTAMP '2024-01-01' AND word NOT IN (SELECT word FROM stop)
            GROUP BY word HAVING count(*) > 10""",
            "basic",
            "stop",
        ),
        "top_words": _query(
            """SELECT word, count(*) AS count FROM basic WHERE ts > TIMESTAMP '2024-01-01'
            GROUP BY word HAVING count(*) > 10 ORDER BY count DESC, word LIMIT 100""",
            "basic",
        ),
        "word_history": _query("SELECT * FROM history", "history"),
        "word_deviation": _query("SELECT * FROM deviation", "deviation"),
        "mean_deviation": _query("SELECT * FROM mean_deviation", "mean_deviation"),
        "seasonal_words": _query("SELECT * FROM seasonal", "seasonal"),
        "seasonal_words_min1": _query("SELECT * FROM seasonal", "seasonal", min_count=1),
        "seasonal_word_list": _query("SELECT DISTINCT word FROM seasonal", "seasonal", min_count=1),
        "seasonal_rows_text": _query(
            """SELECT '[' || concat_ws(',', word, d_morning, d_afternoon, d_evening, d_night) || ']'
                AS line FROM seasonal""",
            "seasonal",
            min_count=1,
        ),
        "fixed_batch_counts": _query("SELECT * FROM fixed_counts", "fixed_counts"),
        "replay_batches": _query(
            """SELECT a.day, a.batch_idx, a.anchor_sec, count(*) AS n_posts
            FROM timed t ASOF JOIN anchors a ON t.day = a.day AND t.sec >= a.anchor_sec
            GROUP BY ALL""",
            "timed",
            "anchors",
        ),
        "replay_batches_events": _query(
            """SELECT a.day, a.batch_idx, a.anchor_sec, count(*) AS n_posts
            FROM (SELECT CAST(ts AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS sec
                  FROM events) t
            ASOF JOIN anchors a ON t.day = a.day AND t.sec >= a.anchor_sec
            GROUP BY ALL""",
            "anchors",
            seconds="event_seconds",
        ),
        "windowed_counts": _query(
            """SELECT *, CAST(sum(n_now) OVER (PARTITION BY word ORDER BY batch_idx
                RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS n_window
            FROM fixed_counts""",
            "fixed_counts",
        ),
        "current_vs_past": _query(
            """SELECT *, batch_idx < (SELECT min(sec) FROM timed) // 3600 + 4 AS is_warmup
            FROM past""",
            "fixed_counts",
            extra=past5,
        ),
        "events_root_rule": _query(_root("past", -2), "fixed_counts", extra=past5),
        "events_poisson_rule": _query(
            _poisson("past", 2), "fixed_counts", extra={**past5, **_interval("past", 4)}
        ),
        "replay_events_root": _query(_root("past", -3, "day", warmup="batch_idx < 1"), "replay_counts", extra=replay),
        "replay_events_poisson": _query(
            _poisson("past", 3, "day", warmup="batch_idx < 1"), "replay_counts", extra={**replay, **_interval("past", 1)}
        ),
        "live_events_poisson": _query(
            _poisson("past", 2, warmup="batch_idx < (SELECT min(sec) FROM timed) // 120 + 4"),
            "live_counts",
            extra={**live, **_interval("past", 4)}
        ),
        "poisson_ci": _query(
            "SELECT total, 4 AS n, round(ci, 4) AS ci FROM ci",
            "fixed_counts",
            extra={**past5, **_interval("past", 4)},
        ),
        "history_baseline": _query(
            f"""SELECT batch_idx, word, count(*) AS n_past, count(*) / 6 AS avg_past
            FROM replayed WHERE day <> {LAST_DAY} GROUP BY batch_idx, word""",
            "replayed",
        ),
        "current_vs_history": _query(history, "versus_history"),
        "current_vs_history_by_hour": _query(history, "versus_history", placed="hourly"),
        "events_vs_history_root": _query(_root("versus_history", -5), "versus_history"),
        "events_vs_history_root_eta2": _query(_root("versus_history", -2), "versus_history"),
        "events_vs_history_poisson": _query(
            _poisson("versus_history", 5),
            "versus_history",
            extra=_interval("versus_history", 6),
        ),
        "events_vs_history_poisson_eta2": _query(
            _poisson("versus_history", 2),
            "versus_history",
            extra=_interval("versus_history", 6),
        ),
        "stopword_arrays": _query(
            """SELECT post_id, CAST(len(words) AS INTEGER) AS n_words,
                   array_to_string(words, ' ') AS words
            FROM kept""",
            "kept",
        ),
        "vocabulary": _query("SELECT * FROM vocabulary", "vocabulary"),
        "bag_of_words": _query(
            """SELECT post_id, term, count(*) AS tf
            FROM (SELECT post_id, unnest(words) AS term FROM kept)
            WHERE term IN (SELECT term FROM vocabulary)
            GROUP BY post_id, term""",
            "kept",
            "vocabulary",
        ),
        "stream_event_words": _query(
            f"""SELECT word, CAST(make_timestamp(batch_idx * 3600 * 1000000) AS DATE) AS day, batch_idx
            FROM ({_root("past", -2)})""",
            "fixed_counts",
            extra=past5,
        ),
        "stream_events_poisson": _query(
            _poisson("past", 2), "fixed_counts", extra={**past5, **_interval("past", 4)}
        ),
        "posts_from_json": _query("SELECT post_id, ts, CAST(NULL AS VARCHAR) AS lang, text FROM posts", "posts"),
        "word_history_by_mean": _query(
            "SELECT day, word, mean FROM history", "history"
        ),
        "replay_batches_by_month": _query(
            """SELECT a.day, a.batch_idx, a.anchor_sec, count(*) AS n_posts
            FROM (SELECT CAST(date_trunc('month', ts) AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) AS sec
                  FROM events) t
            ASOF JOIN anchors a ON t.day = a.day AND t.sec >= a.anchor_sec
            GROUP BY ALL""",
            "anchors",
            seconds="month_seconds",
        ),
        "stream_current_vs_history": _query(history, "versus_history"),
        "stream_events_vs_history_root": _query(_root("versus_history", -2), "versus_history", placed="hourly"),
        "stream_events_vs_history_poisson": _query(
            _poisson("versus_history", 2), "versus_history", placed="hourly", extra=_interval("versus_history", 6)
        ),
        "history_events_union": _query(
            _poisson("versus_history", 2), "versus_history", extra=_interval("versus_history", 6)
        ),
        "lda_topic_terms": """
            SELECT CAST(t AS INTEGER) AS topic, CAST(10 AS INTEGER) AS n_terms, true AS all_known,
                   true AS descending
            FROM range(10) r(t)""",
        "lda_post_sums": post_sums,
        "stream_post_sums": post_sums,
    }
