"""The same questions as plain SQL (DuckDB dialect), to check the queries against.

Common table expressions are put together by name; word lists and tables of suffixes are
shared with the library, patterns and logic are written anew.
"""

from __future__ import annotations

from html import unescape
from html.entities import html5

from topiclens.catalog.queries import EXCLUDED, KEYWORD
from topiclens.functions import stemming
from topiclens.functions.wordlists import STOP_WORDS
from topiclens.plans.testbed import CUT, KEYWORDS, LAST_BIN, LAST_DAY


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


STOPS = words(STOP_WORDS)
SPACE = "[ \\t\\n\\x0B\\f\\r]"
CUT_TS = f"TIMESTAMP '{CUT}'"
# Distance of a time to the cut.
SECONDS = f"date_diff('second', {CUT_TS}, date_trunc('second', ts))"
HOURS = f"({SECONDS} / 3600.0)"


def clean(column: str) -> str:
    joined = f"replace(replace({column}, chr(10), ''), '&nbsp', ' ')"
    return f"trim(lower(regexp_replace({joined}, '[^a-zA-Z0-9''.]+', ' ', 'g')))"


def tokens_of(column: str) -> str:
    trimmed = f"regexp_replace(lower({column}), '{SPACE}+$', '')"
    return f"string_split_regex({trimmed}, '{SPACE}')"


def lookup(values: dict, key: str) -> str:
    """The value of a key in a constant map, or null."""
    keys, found = ", ".join(text(str(k)) for k in values), ", ".join(text(v) for v in values.values())
    return f"MAP([{keys}], [{found}])[{key}]"


#: Of the public table: names with a semicolon, and those that are known without it, too.
CLOSED = {name: chars for name, chars in html5.items() if name[-1] == ";"}
OPEN = {name: chars for name, chars in html5.items() if name[-1] != ";"}
LEGACY = "|".join(sorted(OPEN, key=len, reverse=True))
#: What browsers make of numbers that are no character of their own.
WINDOWS = {str(n): unescape(f"&#{n};") for n in range(160)}


def decode(column: str) -> str:
    """Cut the text before each reference; each part begins with one, but for the first."""
    marked = f"regexp_replace({column}, '&(#[0-9]|#[xX][0-9a-fA-F]|[a-zA-Z])', chr(1) || '&\\1', 'g')"
    digits = "regexp_extract(p, '^&#[xX]?0*([0-9a-fA-F]*)', 1)"
    decimal = "regexp_extract(p, '^&#0*([0-9]*)', 1)"
    number = f"""CASE WHEN regexp_matches(p, '^&#[xX]') THEN
        CASE WHEN length({digits}) > 6 THEN 1114112 ELSE ('0x0' || {digits})::BIGINT END
      WHEN length({decimal}) > 7 THEN 1114112 ELSE ('0' || {decimal})::BIGINT END"""
    char = f"""CASE WHEN {number} < 160 THEN {lookup(WINDOWS, f"({number})::VARCHAR")}
      WHEN {number} > 1114111 OR {number} BETWEEN 55296 AND 57343 THEN chr(65533)
      WHEN {number} BETWEEN 64976 AND 65007 OR {number} % 65536 >= 65534 THEN ''
      ELSE chr(({number})::INTEGER) END"""
    name = "regexp_extract(p, '^&([a-zA-Z][a-zA-Z0-9]{0,31};)', 1)"
    begun = f"regexp_extract(p, '^&({LEGACY})', 1)"
    part = f"""CASE WHEN NOT starts_with(p, '&') THEN p
      WHEN regexp_matches(p, '^&#') THEN {char} || regexp_replace(p, '^&#([xX][0-9a-fA-F]+|[0-9]+);?', '')
      WHEN {lookup(CLOSED, name)} IS NOT NULL
        THEN {lookup(CLOSED, name)} || substr(p, length({name}) + 2)
      WHEN {begun} <> '' THEN {lookup(OPEN, begun)} || substr(p, length({begun}) + 2)
      ELSE p END"""
    return f"array_to_string(list_transform(string_split({marked}, chr(1)), lambda p: {part}), '')"


def singular(t: str) -> str:
    return f"""CASE WHEN regexp_matches({t}, '(ss|us|is)$') OR length({t}) < 3 THEN {t}
        WHEN regexp_matches({t}, '^..+ies$') THEN regexp_replace({t}, 'ies$', 'y')
        WHEN regexp_matches({t}, '(ch|sh|ss|x|z)es$') THEN regexp_replace({t}, 'es$', '')
        WHEN regexp_matches({t}, '^.+men$') THEN regexp_replace({t}, 'men$', 'man')
        WHEN {t} = 'men' THEN {t}
        ELSE regexp_replace({t}, 's$', '') END"""


def shown(column: str) -> str:
    """A page without what is never text, in the order of the page."""
    patterns = (
        "<script\\b.*?(?:</script\\s*>|\\z)",
        "<style\\b.*?(?:</style\\s*>|\\z)",
        "<!--.*?(?:-->|\\z)",
    )
    return f"regexp_replace({column}, '(?is){'|'.join(patterns)}', '', 'g')"


def paragraphs(column: str) -> str:
    """Mark each start and end of a paragraph, split there, keep what follows a start."""
    column = shown(column)
    column = f"regexp_replace({column}, '(?i)<p(\\s[^>]*)?>', chr(1) || chr(2), 'g')"
    ends = "(?i)</p>|</article>|</div>|</body>|<footer"
    column = f"regexp_replace({column}, '{ends}', chr(1), 'g')"
    marked = f"list_filter(string_split({column}, chr(1)), lambda x: starts_with(x, chr(2)))"
    bare = "regexp_replace(substr(x, 2), '<[^>]*>', '', 'g')"
    return f"list_transform({marked}, lambda x: {decode(bare)})"


CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTE[name] = (list(needs), sql)


def with_ctes(names: list[str], sql: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTE[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{name} AS ({CTE[name][1]})" for name in ordered)
    return f"WITH {parts}\n{sql}" if parts else sql


# Inputs -------------------------------------------------------------------------------

cte(
    "hits",
    """SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(post_id % 20 AS INTEGER))
          AS post_published
    FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS uuid,
            user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, ts,
            user_id * 10 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
            CASE event_id % 3 WHEN 0 THEN 'smartphone' WHEN 1 THEN 'desktop'
              ELSE 'tablet' END AS device_type,
            value AS hit_revenue, event_type AS keyword
          FROM events)""",
)
cte(
    "topics",
    "SELECT doc_id AS post_id, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS topic "
    "FROM documents",
)
cte("combined", "SELECT hits.*, topic FROM hits JOIN topics USING (post_id)", "hits", "topics")
cte(
    "crawl",
    """SELECT page_id AS post_id, CASE WHEN page_id % 50 <> 7 THEN url END AS post_url,
      CASE page_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 301 ELSE 200 END AS status, html
    FROM pages""",
)
cte(
    "interest",
    """SELECT date, keyword, 100.0::DOUBLE * n / max(n) OVER (PARTITION BY keyword) AS interest
    FROM (SELECT CAST(ts AS DATE) AS date, event_type AS keyword, count(*) AS n
          FROM events GROUP BY ALL)""",
)
cte(
    "plain",
    f"""SELECT doc_id AS post_id, list_filter(list_transform(
          {tokens_of(clean("translate(text, '‘’ʼ', '')"))},
          lambda x: replace(x, '.', '')),
          lambda x: x <> '' AND NOT regexp_matches(x, '^\\pN+$') AND x NOT IN {STOPS}) AS words
    FROM documents""",
)
cte(
    "plain_counts",
    "SELECT post_id, term, count(*) AS tf FROM (SELECT post_id, unnest(words) AS term FROM plain) "
    "GROUP BY ALL",
    "plain",
)
# A regular plural gives way to its singular if that is a term, too.
cte(
    "lemmas",
    f"""SELECT term, CASE WHEN one IN (SELECT term FROM plain_counts) THEN one ELSE two END AS s
    FROM (SELECT term, {singular("term")} AS one, regexp_replace(term, 's$', '') AS two
      FROM (SELECT DISTINCT term FROM plain_counts))
    WHERE one <> term AND (one IN (SELECT term FROM plain_counts)
      OR (ends_with(term, 's') AND two IN (SELECT term FROM plain_counts)))""",
    "plain_counts",
)
cte(
    "tokens",
    """SELECT post_id, coalesce(list(coalesce(s, term) ORDER BY i) FILTER (term IS NOT NULL), []) AS tokens
    FROM (SELECT post_id, unnest(words) AS term, generate_subscripts(words, 1) AS i FROM plain)
    LEFT JOIN lemmas USING (term) RIGHT JOIN plain USING (post_id) GROUP BY post_id""",
    "plain",
    "lemmas",
)
cte(
    "counts",
    "SELECT post_id, term, count(*) AS tf FROM (SELECT post_id, unnest(tokens) AS term "
    "FROM tokens) GROUP BY ALL",
    "tokens",
)
cte(
    "vocab",
    """SELECT row_number() OVER (ORDER BY corpus_count DESC, term) - 1 AS term_id, *
    FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_freq,
            count(*) FILTER (tf >= 5) AS kept_docs
          FROM counts GROUP BY term HAVING count(*) >= 5
          ORDER BY corpus_count DESC, term LIMIT 2000)""",
    "counts",
)
cte(
    "weighted",
    """SELECT post_id, term, tf,
      tf * ln(((SELECT count(*) FROM documents) + 1) / (kept_docs + 1)) AS tfidf
    FROM counts JOIN vocab USING (term) WHERE tf >= 5""",
    "counts",
    "vocab",
)
cte(
    "centres",
    """SELECT topic, term, sum(tfidf) / any_value(n) AS weight
    FROM weighted JOIN topics USING (post_id)
    JOIN (SELECT topic, count(*) AS n FROM topics GROUP BY topic) USING (topic)
    GROUP BY topic, term""",
    "weighted",
    "topics",
)
cte(
    "dims",
    """SELECT vec_id, label, unnest(generate_series(1, len(embedding))) AS pos,
      CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings""",
)
cte(
    "distances",
    """SELECT vec_id, c.label AS topic, sum((v.x - c.x) * (v.x - c.x)) AS distance
    FROM dims v JOIN (SELECT label, pos, avg(x) AS x FROM dims GROUP BY label, pos) c
      USING (pos)
    GROUP BY vec_id, c.label""",
    "dims",
)
cte(
    "nearest",
    """SELECT vec_id, topic, distance FROM distances
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, topic) = 1""",
    "distances",
)
cte(
    "starts",
    """SELECT session_id, post_id, topic FROM combined
    QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ts, post_id) = 1""",
    "combined",
)
cte(
    "starts_ties",
    """SELECT DISTINCT session_id, post_id, topic FROM combined c
    WHERE date_trunc('day', ts) =
      (SELECT min(date_trunc('day', ts)) FROM combined d WHERE d.session_id = c.session_id)""",
    "combined",
)
for source, target in (("starts", "sessions"), ("starts_ties", "sessions_ties")):
    cte(
        target,
        f"""SELECT session_id, s.topic, sum(hit_revenue) AS revenue, count(c.post_id) AS views
        FROM combined c JOIN {source} s USING (session_id) GROUP BY session_id, s.topic""",
        "combined",
        source,
    )
cte(
    "binned",
    f"""SELECT topic, CAST(floor({HOURS} / 4) * 4 AS INTEGER) AS timeframe,
      count(DISTINCT post_id) AS articles, count(*) AS views, sum(hit_revenue) AS revenue
    FROM combined GROUP BY ALL""",
    "combined",
)
cte("study", "SELECT * FROM binned WHERE timeframe >= 0", "binned")


def daily(source: str) -> str:
    return f"""SELECT CAST(floor(timeframe / 24) AS INTEGER) AS day, topic,
      CAST(sum(articles) AS BIGINT) AS articles, CAST(sum(views) AS BIGINT) AS views,
      sum(revenue) AS revenue FROM {source} GROUP BY ALL"""


cte("daily", daily("study"), "study")
cte("daily_all", daily("binned"), "binned")
WIDE = ", ".join(f"max(interest) FILTER (keyword = '{k}') AS \"{k}\"" for k in KEYWORDS)
COMPLETE = " AND ".join(f'"{k}" IS NOT NULL' for k in KEYWORDS)
cte(
    "wide",
    f"SELECT * FROM (SELECT date, {WIDE} FROM interest GROUP BY date) WHERE {COMPLETE}",
    "interest",
)
cte(
    "revenue_rows",
    f"""SELECT day, topic, revenue, {", ".join(KEYWORDS)} FROM daily
    JOIN (SELECT date_diff('day', CAST({CUT_TS} AS DATE), date) AS day, * FROM wide) USING (day)
    WHERE day BETWEEN 0 AND {LAST_DAY}""",
    "daily",
    "wide",
)

# Least squares, one regressor after the other: each is freed of what the ones before it
# explain, then revenue and the rest are freed of it. `a{i}_{j}` is the slope of the j-th
# variable on the i-th freed one; the last variable, number `N`, is revenue.

REGRESSORS = ["day", *KEYWORDS]
N = len(REGRESSORS)


def _least_squares() -> None:
    names = [*REGRESSORS, "revenue"]
    centred = ", ".join(
        f"CAST({v} AS DOUBLE) - avg({v}) OVER w AS v{i}, avg({v}) OVER w AS m{i}, "
        f"var_pop({v}) OVER w * count(*) OVER w AS s{i}"
        for i, v in enumerate(names)
    )
    cte(
        "ols_0",
        f"SELECT topic, day, revenue, {centred} FROM revenue_rows "
        "WINDOW w AS (PARTITION BY topic)",
        "revenue_rows",
    )
    for i in range(N):
        slopes = ", ".join(
            f"CASE WHEN sum(v{i} * v{i}) OVER w <= 1e-10 * s{i} THEN 0 "
            f"ELSE sum(v{i} * v{j}) OVER w / sum(v{i} * v{i}) OVER w END AS a{i}_{j}"
            for j in range(i + 1, N + 1)
        )
        freed = ", ".join(f"v{j} - a{i}_{j} * v{i} AS v{j}" for j in range(i + 1, N + 1))
        cte(
            f"ols_{i + 1}",
            f"SELECT * REPLACE ({freed}) FROM (SELECT *, {slopes} FROM ols_{i} "
            "WINDOW w AS (PARTITION BY topic))",
            f"ols_{i}",
        )
    # From the last regressor back to the first.
    previous = f"ols_{N}"
    for i in reversed(range(N)):
        rest = "".join(f" - b{j} * a{i}_{j}" for j in range(i + 1, N))
        cte(f"back_{i}", f"SELECT *, a{i}_{N}{rest} AS b{i} FROM {previous}", previous)
        previous = f"back_{i}"
    explained = " + ".join(f"b{i} * m{i}" for i in range(N))
    cte(
        "ols",
        f"""SELECT *, m{N} - ({explained}) AS b_intercept,
          1 - sum(v{N} * v{N}) OVER w / sum((revenue - m{N}) * (revenue - m{N})) OVER w AS r2,
          count(*) OVER w AS days
        FROM {previous} WINDOW w AS (PARTITION BY topic)""",
        previous,
    )


_least_squares()


ALPHA_TOKENS = f"""list_filter(string_split_regex(lower(
    regexp_replace(text, '<[^\\n]+?>|[^a-zA-Z]', ' ', 'g')), ' +'),
    lambda x: x <> '' AND x NOT IN {STOPS})"""


def porter() -> str:
    """The stemmer, one expression per step, over (term, w)."""
    s = stemming

    def ends(word: str, pattern: str) -> str:
        return f"regexp_matches({word}, '{pattern}')"

    def cut(word: str, n: str | int) -> str:
        return f"substr({word}, 1, length({word}) - {n})"

    def shape(word: str) -> str:
        """A word as C and V; y is a vowel after a consonant."""
        vowel_y = f"regexp_replace({word}, '([^aeiou])y', '\\1V', 'g')"
        vowels = f"regexp_replace({vowel_y}, '[aeiouV]', 'V', 'g')"
        return f"regexp_replace({vowels}, '[^V]', 'C', 'g')"

    def above_0(word: str) -> str:
        return f"contains({shape(word)}, 'VC')"

    def above_1(word: str) -> str:
        return ends(shape(word), "^C*V+C+V+C")

    def is_1(word: str) -> str:
        return ends(shape(word), "^C*V+C+V*$")

    def short(word: str) -> str:
        three = f"{ends(shape(word), '^C+VC$')} AND NOT {ends(word, '[wxyY]$')}"
        return f"({three} OR {ends(word, '^[aeiou][^aeiou]$')})"

    def doubled(word: str) -> str:
        return f"({word}[-1] = {word}[-2] AND {ends(word, '[bcdfghjkmnpqrtvwx]$')})"

    def table(values: dict[str, str], key: str) -> str:
        whens = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in values.items())
        return f"CASE {key} {whens} END"

    def split(suffixes, source: str) -> str:
        found = f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"
        rest = cut("w", "length(s)")
        return f"SELECT term, w, s, {rest} AS r FROM (SELECT *, {found} AS s FROM {source})"

    letters = f"""SELECT DISTINCT term, CASE WHEN term[1] = 'y' THEN 'Y' || substr(term, 2)
        ELSE term END AS w FROM (SELECT unnest({ALPHA_TOKENS}) AS term FROM documents)"""
    one_a = f"""SELECT term, CASE WHEN length(w) = 4 AND {ends("w", "ies$")} THEN {cut("w", 1)}
        WHEN {ends("w", "sses$")} OR {ends("w", "ies$")} THEN {cut("w", 2)}
        WHEN {ends("w", "ss$")} THEN w WHEN {ends("w", "s$")} AND w <> 's' THEN {cut("w", 1)}
        ELSE w END AS w FROM letters"""
    mended = f"""CASE WHEN {ends("r", "(at|bl|iz)$")} THEN r || 'e'
        WHEN {doubled("r")} THEN {cut("r", 1)}
        WHEN {ends("r", "(ll|ss|zz)$")} THEN r
        WHEN {is_1("r")} AND {short("r")} THEN r || 'e' ELSE r END"""
    one_b = f"""SELECT term, CASE
        WHEN s = 'ied' THEN CASE WHEN length(w) = 4 THEN {cut("w", 1)} ELSE {cut("w", 2)} END
        WHEN s = 'eed' THEN CASE WHEN {above_0("r")} THEN r || 'ee' ELSE w END
        WHEN s <> '' AND {ends("r", "[aeiouy]")} THEN {mended} ELSE w END AS w
        FROM ({split(["eed", "ied", "ed", "ing"], "one_a")})"""
    one_c = f"""SELECT term, CASE WHEN {ends("w", "^.+[^aeiouy]y$")} THEN {cut("w", 1)} || 'i'
        ELSE w END AS w FROM one_b"""

    def replace_step(values: dict[str, str], source: str) -> str:
        measured = "CASE WHEN s = 'logi' THEN r || 'l' ELSE r END"
        return f"""SELECT term, CASE WHEN s <> '' AND {above_0("(" + measured + ")")}
            THEN r || {table(values, "s")} ELSE w END AS w FROM ({split(values, source)})"""

    four = f"""SELECT term, CASE WHEN s <> '' AND {above_1("r")}
        AND (s <> 'ion' OR {ends("r", "[st]$")}) THEN r ELSE w END AS w
        FROM ({split(s.STEP_4, "three")})"""
    stem = cut("w", 1)
    five_a = f"""SELECT term, CASE WHEN {ends("w", "e$")} AND ({above_1(stem)}
        OR ({is_1(stem)} AND NOT {short(stem)})) THEN {stem} ELSE w END AS w
        FROM four"""
    five_b = f"""SELECT term, CASE WHEN {ends("w", "ll$")} AND {above_1(stem)}
        THEN {stem} ELSE w END AS w FROM five_a"""
    steps = {
        "letters": letters, "one_a": one_a, "one_b": one_b, "one_c": one_c,
        "two": replace_step(s.STEP_2, "one_c"), "three": replace_step(s.STEP_3, "two"),
        "four": four, "five_a": five_a, "five_b": five_b,
    }
    names = ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())
    return f"""WITH {names}
    SELECT term, CASE WHEN {table(s.IRREGULAR, "term")} IS NOT NULL
        THEN {table(s.IRREGULAR, "term")}
        WHEN length(term) <= 2 THEN term ELSE lower(w) END AS stem FROM five_b"""


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *needs: str) -> None:
    ORACLE[name] = with_ctes(list(needs), sql)


def token_rows(tokens: str, source: str) -> str:
    return f"""SELECT post_id, CAST(len(tokens) AS INTEGER) AS n_tokens,
      array_to_string(tokens, '|') AS tokens FROM (SELECT post_id, {tokens} AS tokens
      FROM {source})"""


DOCS = "(SELECT doc_id AS post_id, text FROM documents)"
CLEAN_TOKENS = f"list_filter({tokens_of(clean('text'))}, lambda x: x <> '')"
STAMP = "'%Y-%m-%d %H:%M:%S'"

# Choosing and routing -----------------------------------------------------------------

oracle("project", "SELECT doc_id AS post_id, text FROM documents")
oracle("drop_column", "SELECT doc_id, text AS body, lang, source FROM documents")
oracle(
    "row_range",
    "SELECT post_id, post_url, status FROM crawl ORDER BY post_id LIMIT 30 OFFSET 10",
    "crawl",
)
oracle("first_n", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 100")
oracle(
    "row_range_far",
    """SELECT doc_id, lang FROM documents d
    WHERE (SELECT count(*) FROM documents e WHERE e.doc_id < d.doc_id) BETWEEN 110 AND 189""",
)
oracle("row_count", "SELECT count(*) AS articles FROM documents")
oracle(
    "limit_n",
    "SELECT session_id, topic, round(revenue, 6) AS revenue, views FROM sessions "
    "ORDER BY session_id LIMIT 5",
    "sessions",
)
SOME_PLAIN = """(CASE WHEN post_id % 5 = 0
      THEN regexp_replace(html, '<(/?)p>', '<\\1section>', 'g') ELSE html END)"""
oracle(
    "non_empty",
    f"""SELECT * FROM (SELECT post_id, {clean("text")} AS text FROM (
      SELECT post_id, array_to_string({paragraphs(SOME_PLAIN)}, '') AS text FROM crawl))
    WHERE text <> ''""",
    "crawl",
)
oracle(
    "not_redirect",
    f"SELECT post_id, text FROM {DOCS} WHERE post_id % 7 <> 0 AND NOT starts_with(text, '#REDIRECT')",
)
oracle(
    "keyword_articles",
    f"SELECT post_id, -1 AS topic FROM {DOCS} WHERE contains(text, '{KEYWORD}')",
)
oracle(
    "exclude_keywords",
    f"SELECT post_id FROM {DOCS} WHERE "
    + " AND ".join(f"NOT contains(text, '{word}')" for word in EXCLUDED),
)
oracle(
    "page_status",
    """SELECT post_id, post_url, status, CASE WHEN post_url IS NULL THEN 'failed'
      WHEN status // 100 = 3 THEN 'redirect' WHEN status // 100 = 2 THEN 'ok'
      ELSE 'failed' END AS page_status FROM crawl""",
    "crawl",
)

# Text -----------------------------------------------------------------------------------

oracle(
    "extract_paragraphs",
    f"""SELECT post_id, CAST(len(p) AS INTEGER) AS paragraphs, array_to_string(p, '') AS text
    FROM (SELECT post_id, {paragraphs("html")} AS p FROM crawl)""",
    "crawl",
)
TITLE = f"regexp_extract({shown('html')}, '(?is)<title[^>]*>(.*?)</title>', 1)"
oracle("page_title", f"SELECT page_id AS post_id, {decode(TITLE)} AS title FROM pages")
oracle("clean_text", f"SELECT post_id, {clean('text')} AS text FROM {DOCS}")
DELETED = """regexp_replace(replace(text, '&nbsp;', ' '),
    '[^a-zA-Z0-9 \\t\\r\\x0B\\f]', '', 'g')"""
oracle("clean_text_delete", f"SELECT post_id, {DELETED} AS text FROM {DOCS}")
oracle("tokenize", token_rows(tokens_of("text"), DOCS))
oracle(
    "tokenize_alpha",
    token_rows(
        "list_filter(string_split_regex(lower(regexp_replace(html, "
        "'<[^\\n]+?>|[^a-zA-Z]', ' ', 'g')), ' +'), lambda x: x <> '')",
        "crawl",
    ),
    "crawl",
)
oracle(
    "drop_numeric",
    token_rows(
        f"list_filter(list_transform({CLEAN_TOKENS}, lambda x: replace(x, '.', '')), "
        "lambda x: x <> '' AND NOT regexp_matches(x, '^\\pN+$'))",
        DOCS,
    ),
)
oracle(
    "remove_stopwords",
    token_rows(f"list_filter({CLEAN_TOKENS}, lambda x: x NOT IN {STOPS})", DOCS),
)
oracle(
    "lemmatize",
    """SELECT post_id, coalesce(s, term) AS term, CAST(sum(tf) AS BIGINT) AS tf
    FROM plain_counts LEFT JOIN lemmas USING (term) GROUP BY 1, 2""",
    "plain_counts",
    "lemmas",
)
ORACLE["stem_terms"] = porter()
ORACLE["stemmed_counts"] = f"""SELECT post_id, stem AS term, count(*) AS tf
    FROM (SELECT doc_id AS post_id, unnest({ALPHA_TOKENS}) AS term FROM documents)
    JOIN ({porter()}) USING (term) GROUP BY 1, 2"""
oracle(
    "prepared_text",
    f"""SELECT post_id, array_to_string(list_filter(list_transform(list_filter(
      {tokens_of(DELETED)}, lambda x: x <> ''), lambda x: {singular("x")}),
      lambda x: x NOT IN {STOPS}), ' ') AS text FROM {DOCS}""",
)
oracle(
    "ngrams",
    """SELECT term, count(*) AS corpus_count, count(DISTINCT post_id) AS doc_freq
    FROM (SELECT post_id, unnest(list_transform(generate_series(1, len(tokens) - 1),
            lambda i: tokens[i] || ' ' || tokens[i + 1])) AS term FROM tokens)
    GROUP BY term""",
    "tokens",
)

# Features and topics --------------------------------------------------------------------

oracle("term_counts", "SELECT post_id, term, tf FROM counts", "counts")
oracle("vocabulary", "SELECT CAST(term_id AS INTEGER) AS term_id, term, corpus_count, doc_freq, kept_docs FROM vocab", "vocab")
oracle("tfidf", "SELECT post_id, term, tf, round(tfidf, 6) AS tfidf FROM weighted", "weighted")
oracle("centroids", "SELECT topic, term, round(weight, 6) AS weight FROM centres", "centres")
oracle(
    "topic_top_terms",
    """SELECT topic, term, weight, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank
      FROM (SELECT topic, term, round(weight, 6) AS weight FROM centres)) WHERE rank <= 10""",
    "centres",
)
oracle("topic_sizes", "SELECT topic, count(*) AS articles FROM topics GROUP BY topic", "topics")
oracle(
    "nearest_centroid",
    "SELECT vec_id, topic, round(distance, 6) AS distance FROM nearest",
    "nearest",
)
oracle(
    "clustering_cost",
    "SELECT round(sum(distance), 4) AS cost, round(sum(distance) / 1000000, 9) AS scaled_cost "
    "FROM nearest",
    "nearest",
)

# Hits, sessions, devices ----------------------------------------------------------------

oracle(
    "hits_with_topic",
    f"""SELECT event_id, session_id, post_id, topic, {SECONDS} AS timeframe, hit_revenue,
      device_type FROM combined""",
    "combined",
)
oracle(
    "session_first_ts",
    f"SELECT session_id, strftime(min(ts), {STAMP}) AS first_ts FROM combined GROUP BY 1",
    "combined",
)
oracle("session_starts", "SELECT * FROM starts", "starts")
oracle("session_starts_ties", "SELECT * FROM starts_ties", "starts_ties")
for name, source in (("session_metrics", "sessions"), ("session_metrics_ties", "sessions_ties")):
    oracle(
        name,
        f"SELECT session_id, topic, round(revenue, 6) AS revenue, views FROM {source}",
        source,
    )
oracle(
    "session_metrics_by_topic",
    """SELECT topic, count(*) AS sessions, round(sum(revenue), 6) AS revenue,
      CAST(sum(views) AS BIGINT) AS views,
      round(sum(revenue) / count(*), 9) AS revenue_per_session FROM sessions GROUP BY topic""",
    "sessions",
)
oracle(
    "avg_hit_by_topic",
    "SELECT topic, round(avg(hit_revenue), 9) AS avg_hit FROM combined GROUP BY topic",
    "combined",
)
oracle(
    "device_counts",
    """SELECT topic, count(*) FILTER (device_type = 'smartphone') AS smartphone_hits,
      count(*) FILTER (device_type = 'desktop') AS desktop_hits, count(*) AS hits
    FROM combined GROUP BY topic""",
    "combined",
)
oracle(
    "device_share",
    """SELECT topic, round(avg(CASE WHEN device_type = 'smartphone' THEN 1.0 ELSE 0 END), 9)
      AS device_share,
      round(avg(CASE WHEN device_type = 'smartphone' THEN 0.0 ELSE 1 END), 9) AS other_share
    FROM combined GROUP BY topic""",
    "combined",
)
oracle(
    "device_outer_join",
    """SELECT topic, smartphone_hits, desktop_hits FROM
      (SELECT topic, count(*) AS smartphone_hits FROM combined
       WHERE device_type = 'smartphone' GROUP BY topic)
      FULL JOIN (SELECT topic, count(*) AS desktop_hits FROM combined
       WHERE device_type = 'desktop' GROUP BY topic) USING (topic)""",
    "combined",
)
oracle(
    "topic_weekday",
    """SELECT topic, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
      count(DISTINCT post_id) AS articles, count(*) AS views,
      round(sum(hit_revenue), 6) AS revenue FROM combined GROUP BY ALL""",
    "combined",
)
oracle(
    "topic_lifespan",
    """SELECT topic, count(*) AS views, round(avg(age), 9) AS mean_age,
      round(quantile_cont(age, 0.5), 9) AS median_age,
      round(quantile_cont(age, 0.9), 9) AS p90_age, max(age) AS last_age
    FROM (SELECT topic, CAST(floor(date_diff('second', post_published,
            date_trunc('second', ts)) / 3600.0) AS BIGINT) AS age FROM combined)
    WHERE age >= 0 GROUP BY topic""",
    "combined",
)

# Time -----------------------------------------------------------------------------------

oracle(
    "time_since_cut",
    f"SELECT event_id, {SECONDS} AS seconds, round({SECONDS} / 3600.0::DOUBLE, 6) AS hours "
    "FROM events",
)
oracle(
    "days_since_cut",
    f"""SELECT strftime(date, '%Y-%m-%d') AS date, keyword,
      CAST(date_diff('day', CAST({CUT_TS} AS DATE), date) AS INTEGER) AS day FROM interest""",
    "interest",
)
oracle(
    "hour_to_day",
    f"""SELECT event_id, CAST(floor({HOURS}) AS INTEGER) AS hour,
      CAST(floor({HOURS} / 4) * 4 AS INTEGER) AS bin,
      CAST(floor({HOURS} / 24) AS INTEGER) AS day FROM events""",
)
oracle(
    "day_to_date",
    f"""SELECT topic, timeframe,
      strftime({CUT_TS} + to_hours(timeframe), '%Y-%m-%d') AS date,
      strftime({CUT_TS} + to_hours(timeframe), {STAMP}) AS bin_start FROM binned""",
    "binned",
)

# Series ---------------------------------------------------------------------------------

SERIES = "topic, timeframe, articles, views, round(revenue, 6) AS revenue"
oracle("binned_metrics", f"SELECT {SERIES} FROM binned", "binned")
oracle("stream_binned_metrics", f"SELECT {SERIES} FROM binned", "binned")
oracle("after_cut", f"SELECT {SERIES} FROM study", "study")
oracle("topic_series", f"SELECT {SERIES} FROM study", "study")
DAILY = "day, topic, articles, views, round(revenue, 6) AS revenue"
oracle(
    "study_window",
    f"SELECT {DAILY} FROM daily_all WHERE day BETWEEN 0 AND {LAST_DAY}",
    "daily_all",
)
oracle("topic_daily", f"SELECT {DAILY} FROM daily", "daily")
oracle("timeframes", "SELECT DISTINCT timeframe FROM study ORDER BY timeframe", "study")
oracle(
    "base_series",
    """SELECT timeframe, CAST(sum(articles) AS BIGINT) AS articles,
      CAST(sum(views) AS BIGINT) AS views, round(sum(revenue), 6) AS revenue
    FROM study GROUP BY timeframe""",
    "study",
)
oracle(
    "revenue_per_view",
    "SELECT topic, round(sum(revenue) / sum(views), 9) AS revenue_per_view FROM study "
    "GROUP BY topic",
    "study",
)
oracle(
    "rpv_daily",
    "SELECT topic, day, round(revenue / views, 9) AS revenue_per_view FROM daily",
    "daily",
)
oracle(
    "dense_series",
    f"""SELECT topic, CAST(timeframe AS INTEGER) AS timeframe,
      coalesce(articles, 0) AS articles, coalesce(views, 0) AS views,
      round(coalesce(revenue, 0), 6) AS revenue
    FROM (SELECT DISTINCT topic FROM binned)
    CROSS JOIN (SELECT unnest(generate_series(0, {LAST_BIN}, 4)) AS timeframe)
    LEFT JOIN binned USING (topic, timeframe)""",
    "binned",
)
SCALED = ", ".join(
    f"round(({m} - avg({m}) OVER w) / coalesce(nullif(stddev_pop({m}) OVER w, 0), 1), 6) AS {m}"
    for m in ("articles", "views", "revenue")
)
oracle(
    "standardized_series",
    f"SELECT topic, timeframe, {SCALED} FROM study WINDOW w AS (PARTITION BY topic)",
    "study",
)

# Interest and regression ----------------------------------------------------------------

ROUNDED = ", ".join(f'round("{k}", 6) AS "{k}"' for k in KEYWORDS)
oracle("interest_wide", f"SELECT strftime(date, '%Y-%m-%d') AS date, {ROUNDED} FROM wide", "wide")
oracle(
    "revenue_with_interest",
    f"SELECT CAST(day AS INTEGER) AS day, topic, round(revenue, 6) AS revenue, {ROUNDED} "
    "FROM revenue_rows",
    "revenue_rows",
)
oracle(
    "topic_trendline",
    f"""SELECT topic, strftime(date, '%Y-%m-%d') AS date,
      round(sum(interest * weight), 6) AS trendline
    FROM interest JOIN (
      SELECT topic, keyword, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY topic) AS weight
      FROM combined GROUP BY topic, keyword) USING (keyword)
    GROUP BY topic, date""",
    "interest",
    "combined",
)
COEFFICIENTS = " UNION ALL ".join(
    f"SELECT DISTINCT topic, '{name}' AS variable, round(b{i}, 6) AS coefficient, "
    "round(r2, 6) AS r2, days FROM ols"
    for i, name in [("_intercept", "intercept"), *enumerate(REGRESSORS)]
)
oracle("revenue_ols", COEFFICIENTS, "ols")
oracle(
    "revenue_predicted",
    f"""SELECT topic, CAST(day AS INTEGER) AS day, round(revenue, 4) AS actual,
      round(revenue - v{N}, 4) AS predicted, round(r2, 4) AS r2 FROM ols""",
    "ols",
)
oracle(
    "revenue_regr",
    """SELECT topic, round(regr_slope(revenue, "view"), 6) AS slope,
      round(regr_intercept(revenue, "view"), 6) AS intercept,
      round(regr_r2(revenue, "view"), 6) AS r2 FROM revenue_rows GROUP BY topic""",
    "revenue_rows",
)

# Polarity, transitions, shares -----------------------------------------------------------

WORDS_OF = """list_filter(string_split_regex(lower(
    regexp_replace(text, '<[^\\n]+?>|[^a-zA-Z]', ' ', 'g')), ' +'), lambda x: x <> '')"""
cte(
    "grams",
    f"""SELECT post_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS term
    FROM (SELECT *, unnest(range(1, len(w) + 2 - n)) AS i
      FROM (SELECT doc_id AS post_id, {WORDS_OF} AS w, unnest([1, 2, 3, 4]) AS n FROM documents))""",
)
cte(
    "lexicon",
    """SELECT * FROM (SELECT term, (20 * sum(quality) + count(*)) // (2 * count(*)) - 5 AS polarity
      FROM (SELECT DISTINCT post_id, term FROM grams WHERE n <= 2)
      JOIN labels ON doc_id = post_id GROUP BY term HAVING count(*) >= 5) WHERE polarity <> 0""",
    "grams",
)
cte("matches", "SELECT * FROM grams JOIN lexicon USING (term)", "grams", "lexicon")
cte(
    "polarities",
    """SELECT post_id, coalesce(sum(polarity), 0)::BIGINT AS polarity, count(polarity) AS matches
    FROM (SELECT doc_id AS post_id FROM documents) LEFT JOIN (
      SELECT * FROM matches m WHERE NOT EXISTS (FROM matches x WHERE x.post_id = m.post_id
        AND x.n > m.n AND x.i <= m.i AND x.i + x.n >= m.i + m.n)) USING (post_id)
    GROUP BY post_id""",
    "matches",
)
oracle("polarity", "SELECT * FROM polarities", "polarities")
oracle(
    "metrics_by_polarity",
    """SELECT sign(polarity)::INTEGER AS bucket, count(DISTINCT post_id) AS articles,
      count(*) AS views, round(sum(hit_revenue), 6) AS revenue
    FROM hits JOIN polarities USING (post_id) GROUP BY 1""",
    "hits",
    "polarities",
)
oracle(
    "event_transitions",
    """SELECT event, next_event, count(*) AS transitions,
      round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY event), 9) AS probability
    FROM (SELECT keyword AS event, lead(keyword) OVER (PARTITION BY session_id
            ORDER BY ts, event_id) AS next_event FROM hits)
    WHERE next_event IS NOT NULL GROUP BY event, next_event""",
    "hits",
)
oracle(
    "top_decile_share",
    """SELECT count(*) AS users, count(*) FILTER (top) AS top_users,
      round(sum(revenue), 6) AS revenue, round(sum(revenue) FILTER (top), 6) AS top_revenue,
      round(sum(revenue) FILTER (top) / sum(revenue), 9) AS top_share
    FROM (SELECT revenue, row_number() OVER (ORDER BY revenue DESC, uuid)
            <= ceil(count(*) OVER () / 10) AS top
          FROM (SELECT uuid, sum(hit_revenue) AS revenue FROM hits GROUP BY uuid))""",
    "hits",
)
oracle(
    "stream_keyword_views",
    f"SELECT strftime(date_trunc('day', ts), {STAMP}) AS start, event_type AS keyword, "
    "count(*) AS views FROM events GROUP BY ALL",
)

# Files written and read again ---------------------------------------------------------------

oracle(
    "hits_file",
    f"""SELECT uuid, session_id, strftime(ts, {STAMP}) AS ts, post_id,
      'http://example.com/a,b' AS post_url, device_type, round(hit_revenue, 6) AS hit_revenue
    FROM hits""",
    "hits",
)
oracle(
    "articles_file",
    f"SELECT * FROM (SELECT post_id, {clean('text')} AS text FROM {DOCS}) WHERE text <> ''",
)
for name in ("topic_map_file", "by_topic_files"):
    oracle(name, "SELECT post_id, topic FROM topics", "topics")
ORACLE["pages_by_status_files"] = ORACLE["page_status"]
oracle(
    "text_lines_file",
    "SELECT DISTINCT translate(text, chr(13) || chr(10), '  ') AS text, 1::BIGINT AS ids FROM documents",
)
# What must be true of fitted models -------------------------------------------------------

oracle("model_roundtrip_same", "SELECT doc_id AS post_id, 1 AS same FROM documents")
oracle("kmeans_gap", "SELECT doc_id AS post_id, 0.0::DOUBLE AS gap FROM documents")
cte(
    "whole",
    """SELECT * FROM (SELECT post_id, term, term_id, CAST(floor(tfidf * 4096 + 0.5) AS BIGINT) AS x
      FROM weighted JOIN vocab USING (term)) WHERE x > 0""",
    "weighted",
    "vocab",
)
cte(
    "starts",
    """SELECT row_number() OVER (ORDER BY h) - 1 AS topic, split_part(h, ' ', 2)::BIGINT AS post_id
    FROM (
      SELECT min(md5(doc_id::VARCHAR) || ' ' || doc_id) AS h
      FROM (SELECT doc_id, coalesce(string_agg(term_id || ':' || x, ',' ORDER BY term_id), '') AS v
        FROM documents LEFT JOIN whole ON post_id = doc_id GROUP BY doc_id)
      GROUP BY v ORDER BY h LIMIT 25)""",
    "whole",
)
cte(
    "moved",
    """SELECT post_id, topic FROM (
      SELECT doc_id AS post_id, s.topic, row_number() OVER (PARTITION BY doc_id
        ORDER BY coalesce(square, 0) - 2 * coalesce(dot, 0), s.topic) AS nth
      FROM documents CROSS JOIN starts s
      LEFT JOIN (SELECT topic, sum(x * x) AS square FROM whole JOIN starts USING (post_id) GROUP BY topic) q
        ON q.topic = s.topic
      LEFT JOIN (SELECT w.post_id, topic, sum(w.x * c.x) AS dot
        FROM whole w JOIN (SELECT topic, term_id, x FROM whole JOIN starts USING (post_id)) c USING (term_id)
        GROUP BY w.post_id, topic) d ON d.post_id = doc_id AND d.topic = s.topic
    ) WHERE nth = 1""",
    "whole",
    "starts",
)
oracle(
    "kmeans_step",
    """SELECT CAST(topic AS INTEGER) AS topic, term, CAST(weight AS BIGINT) AS weight FROM (
      SELECT topic, term, (2 * sum(x) + any_value(n)) // (2 * any_value(n)) AS weight
      FROM whole JOIN moved USING (post_id)
      JOIN (SELECT topic, count(*) AS n FROM moved GROUP BY topic) USING (topic)
      GROUP BY topic, term) WHERE weight > 0""",
    "whole",
    "moved",
)
cte(
    "near",
    """SELECT word, context, count(*) AS n
    FROM (
      SELECT tokens[i] AS word, tokens[i + d] AS context
      FROM (SELECT *, unnest([-5, -4, -3, -2, -1, 1, 2, 3, 4, 5]) AS d
        FROM (SELECT tokens, unnest(range(1, len(tokens) + 1)) AS i FROM tokens))
      WHERE i + d BETWEEN 1 AND len(tokens))
    WHERE context IN (FROM (SELECT term FROM counts GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 2000))
    GROUP BY word, context""",
    "tokens",
    "counts",
)
oracle(
    "word_pairs",
    """SELECT word, count(*) AS contexts, CAST(sum(n) AS BIGINT) AS n,
      round(sum(weight), 4) AS weight, min({'n': -n, 'context': context}).context AS commonest
    FROM (
      SELECT word, context, n,
        ln(n::DOUBLE * sum(n) OVER () / (w::DOUBLE * sum(n) OVER (PARTITION BY context))) AS weight
      FROM (SELECT *, sum(n) OVER (PARTITION BY word) AS w FROM near) WHERE w >= 5)
    WHERE weight > 0 GROUP BY word""",
    "near",
)
oracle(
    "k_sweep_falls",
    "SELECT * FROM (VALUES (3, 10, 1), (10, 25, 1)) steps(fewer, k, falls)",
)
oracle(
    "lda_known_terms",
    "SELECT CAST(topic AS INTEGER) AS topic, (SELECT count(*) FROM (FROM vocab LIMIT 10)) AS terms "
    "FROM range(5) r(topic)",
    "vocab",
)
oracle(
    "classified_pages",
    f"""SELECT post_id, 1 AS known FROM (
      SELECT post_id, array_to_string({paragraphs("html")}, '') AS text FROM crawl
      WHERE post_url IS NOT NULL AND status = 200) WHERE {clean("text")} <> ''""",
    "crawl",
)
oracle(
    "synonyms_known",
    "SELECT least(10, count(*)) AS synonyms FROM (SELECT term FROM counts GROUP BY term "
    f"HAVING sum(tf) >= 5) WHERE term <> '{KEYWORD}'",
    "counts",
)
