"""DuckDB SQL for every registered query: the correctness oracle.

Each builder below is the SQL twin of a Column function in ``jobmart.functions``
and reads the same fixed dictionaries; patterns are written out here.  DuckDB specifics: global
``regexp_replace`` needs the 'g' flag, BIGINT casts round (so ``trunc`` first),
lambdas use ``lambda x:``.  Ids are 64-bit hashes on the Spark side, which
DuckDB cannot compute, so oracle queries compare on natural keys.
"""

from __future__ import annotations

from urllib.parse import quote_plus as py_quote_plus

from .. import dictionaries as D
from ..sources import postings as P

# the patterns, written out here on their own: none is taken from the code they check
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WS_RUN = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
DATE_LEAD = r"^([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
DATE_ANY = r"([0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})"
LABEL_PATTERNS = {
    label: r"(?:^|[^\p{L}\p{N}_])" + label + r"\s*:\s*(.*?)\s*(?:công ty\s*:|địa điểm\s*:|ngày cập nhật\s*:|$)"
    for label in ("công ty", "địa điểm", "ngày cập nhật")}
_GAP = WS + "*"


def _salary(template: str, number: str) -> str:
    """``#`` is a number, ``~`` optional white space, ``$`` the unit, ``=`` a range sign."""
    return (template.replace("~", _GAP).replace("#", f"({number})").replace("$", "(?:triệu|tr|vnd|vnđ)")
            .replace("=", "(?:-|đến|tới)"))


_PLAIN = r"[0-9][0-9\.]*"
SALARY = [(_salary(t, _PLAIN), n, rule) for t, n, rule in (
    ("#~=~#~$", 2, "pair"), ("#~=~#", 2, "pair"), ("up to~#~$", 1, "est_raw"), ("from~#~$", 1, "est_raw"),
    ("#~$~-~#~$", 2, "pair"), ("#~$", 1, "est"))]
_STRICT = r"[0-9]+(?:[\.,][0-9]{3})*(?:[\.,][0-9]{1,2})?"
SALARY_STRICT = [(_salary(t, _STRICT), n, rule) for t, n, rule in (
    ("#~=~#~$", 2, "pair"), ("up to~#~$", 1, "est"), ("from~#~$", 1, "est"), ("#~$~=~#~$", 2, "pair"), ("#~$", 1, "est"))]

_SPECIAL = set("\\.^$|?*+()[]{}")


def escape(text: str) -> str:
    return "".join("\\" + c if c in _SPECIAL else c for c in text)


def whole_word_pattern(keywords: list[str]) -> str:
    """Any keyword between word boundaries: beside a word character stands none or an edge,
    beside another character a word character."""
    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    inside = lambda c: c.isalnum() or c == "_"
    return "(?:" + "|".join(
        (f"(?:^|{other})" if inside(k[0]) else word) + escape(k) + (f"(?:$|{other})" if inside(k[-1]) else word)
        for k in keywords) + ")"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def pick(key: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {key} = {i} THEN {q(v)}" for i, v in enumerate(values)) + " END"


# --- sources ---------------------------------------------------------------
def derived_postings_sql() -> str:
    k = "o.o_orderkey"
    platform = pick(f"{k} % 3", P.FIX_PLATFORMS)
    location = pick("o.o_custkey % 7", P.FIX_LOCATIONS)
    date_txt = (f"CASE WHEN {k} % 4 = 0 THEN strftime(o.o_orderdate, '%Y-%m-%d') "
                f"ELSE strftime(o.o_orderdate, '%d/%m/%Y') END")
    desc = (f"CASE WHEN {k} % {P.DESC_EMPTY_MOD} = {P.DESC_EMPTY_REM} THEN '' ELSE "
            f"'<p>Công ty: ' || c.c_name || ' Địa điểm: ' || {location} || ' Ngày cập nhật: ' || "
            f"{date_txt} || '</p> <div>' || {pick(f'{k} % 11', P.FIX_SKILLS)} || '</div> ' || "
            f"{pick(f'{k} % 13', P.FIX_SALARIES)} || ' Chi tiết' END")
    url_key = f"CASE WHEN {k} % {P.DUP_MOD} = {P.DUP_REM} THEN {k} - {P.DUP_SHIFT} ELSE {k} END"
    return f"""SELECT {k} AS ingest_seq, {k} % 2 AS batch, {platform} AS platform,
  'https://' || {platform} || '.example/job/' || CAST({url_key} AS VARCHAR) AS job_url,
  CASE WHEN {k} % {P.TITLE_NULL_MOD} = {P.TITLE_NULL_REM} THEN NULL ELSE {pick(f'{k} % 8', P.FIX_TITLES)} END AS job_title,
  c.c_name AS company, {location} AS location, {desc} AS job_description,
  CASE WHEN {k} % 3 = 1 THEN NULL ELSE 'hạn nộp hồ sơ: ' || strftime(o.o_orderdate, '%d/%m/%Y') END AS posting_date,
  strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS scraped_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


# --- scalar twins ------------------------------------------------------------
def has_whole_word(text: str, keywords: list[str]) -> str:
    pre = " OR ".join(f"instr({text}, {q(k)}) > 0" for k in keywords)
    return f"(({pre}) AND regexp_matches({text}, {q(whole_word_pattern(keywords))}))"


def clean_description(c: str) -> str:
    s = f"lower({c})"
    s = f"regexp_replace({s}, '<[^>]+>', '', 'g')"
    s = f"regexp_replace({s}, {q(WS_RUN)}, ' ', 'g')"
    s = f"regexp_replace({s}, {q('(?:' + '|'.join(escape(p) for p in D.BOILERPLATE) + ')')}, '', 'g')"
    words = (f"list_filter(regexp_split_to_array({s}, {q(WS_RUN)}), "
             f"lambda w: length(w) > 0 AND length(w) < {D.MAX_WORD_CHARS})")
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL "
            f"ELSE nullif(array_to_string({words}, ' '), '') END")


def normalize_text(c: str) -> str:
    s = f"replace(replace(coalesce({c}, ''), chr(160), ' '), chr(8203), '')"
    return f"trim(regexp_replace({s}, {q(WS_RUN)}, ' ', 'g'), ' ')"


def clean_html(c: str) -> str:
    return normalize_text(f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g')")


def truncate_text(c: str, n: int = 500, suffix: str = "...") -> str:
    return (f"CASE WHEN length({c}) <= {n} THEN {c} "
            f"ELSE substr({c}, 1, {n - len(suffix)}) || {q(suffix)} END")


def seniority(text: str, unknown: str | None = None) -> str:
    parts = " ".join(f"WHEN {has_whole_word(text, D.SENIORITY_LEVELS[lvl])} THEN {q(lvl)}"
                     for lvl in D.SENIORITY_PRIORITY)
    return f"CASE {parts} ELSE {q(unknown) if unknown else 'NULL'} END"


def skills_list(text: str) -> str:
    items = [f"CASE WHEN {has_whole_word(text, kws)} THEN "
             f"{{'skill_name': {q(name)}, 'skill_category': {q(kind)}}} END"
             for _, name, kind, kws in D.skill_entries()]
    return f"list_filter([{', '.join(items)}], lambda s: s IS NOT NULL)"


def canonical_location(c: str) -> str:
    norm = f"regexp_replace(regexp_replace(lower({c}), {q('^' + WS + '+')}, ''), {q(WS + '+$')}, '')"
    cases = " ".join(f"WHEN {q(a)} THEN {q(canon)}" for a, canon in D.alias_map().items())
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN '' ELSE coalesce(CASE {norm} {cases} END, {norm}) END"


def label_value(clean: str, label: str) -> str:
    return f"regexp_extract(coalesce({clean}, ''), {q(LABEL_PATTERNS[label])}, 1)"


def parse_date(s: str) -> str:
    return f"CAST(coalesce(try_strptime({s}, '%d/%m/%Y'), try_strptime({s}, '%Y-%m-%d')) AS DATE)"


def posted_date(clean: str, raw: str) -> str:
    lab = parse_date(f"nullif(regexp_extract({label_value(clean, D.LABEL_POSTED)}, {q(DATE_LEAD)}, 1), '')")
    fb = parse_date(f"nullif(regexp_extract(coalesce({raw}, ''), {q(DATE_ANY)}, 1), '')")
    return f"coalesce({lab}, {fb})"


LONG_MAX_D = "9.223372036854776e18"
SCALE_LIMIT = 9223372036854  # largest value that can be multiplied by 1e6 in a BIGINT


def salary_columns(text: str) -> str:
    """SELECT-list fragment producing salary_min, salary_max, salary_currency,
    salary_overflow from an already lower-cased text column."""
    pats = SALARY
    tagged = "coalesce(" + ", ".join(
        f"nullif('{i}' || regexp_extract({text}, {q(p)}, 0), '{i}')" for i, (p, _, _) in enumerate(pats)) + ")"
    return f"{tagged} AS _tagged"


def salary_finish(prefix: str = "") -> str:
    pats = SALARY
    idx = "CAST(substr(_tagged, 1, 1) AS INTEGER)"
    m = "substr(_tagged, 2)"

    def grp(g: int) -> str:
        whens = " ".join(f"WHEN {idx} = {i} THEN regexp_extract({m}, {q(p)}, {g})"
                         for i, (p, n, _) in enumerate(pats) if n >= g)
        return f"replace(CASE {whens} END, '.', '')"

    def num(g: int) -> str:
        d = f"TRY_CAST({grp(g)} AS DOUBLE)"
        return f"CASE WHEN abs({d}) < {LONG_MAX_D} THEN CAST(trunc({d}) AS BIGINT) END"

    def over(g: int) -> str:
        d = f"TRY_CAST({grp(g)} AS DOUBLE)"
        return f"({d} IS NOT NULL AND NOT (abs({d}) < {LONG_MAX_D}))"

    rule = "CASE " + " ".join(f"WHEN {idx} = {i} THEN {q(r)}" for i, (_, _, r) in enumerate(pats)) + " END"
    return f"""
  {num(1)} AS _min_raw, {num(2)} AS _max_raw, {over(1)} AS _min_over, {over(2)} AS _max_over,
  {rule} AS _rule, (instr({m}, 'tr') > 0) AS _has_tr"""


def salary_final() -> str:
    scale = "(_has_tr OR _min_raw < 1000000)"

    def scaled(v: str) -> str:
        return (f"CASE WHEN {scale} THEN (CASE WHEN abs({v}) <= {SCALE_LIMIT} THEN {v} * 1000000 END) "
                f"ELSE {v} END")

    min_s = scaled("_min_raw")
    max_p = scaled("_max_raw")
    over = (f"(_min_over OR (_min_raw IS NOT NULL AND ({min_s}) IS NULL) OR "
            f"(_rule = 'pair' AND (_max_over OR (_max_raw IS NOT NULL AND ({max_p}) IS NULL))))")
    ok = f"(_tagged IS NOT NULL AND NOT coalesce({over}, false))"
    max_val = (f"CASE WHEN _rule = 'pair' THEN CAST({max_p} AS DOUBLE) "
               f"WHEN _rule = 'est_raw' THEN CAST(_min_raw AS DOUBLE) * 1.2 "
               f"WHEN _rule = 'est' THEN CAST({min_s} AS DOUBLE) * 1.2 END")
    return f"""
  CASE WHEN {ok} THEN {min_s} END AS salary_min,
  CASE WHEN {ok} THEN {max_val} END AS salary_max,
  CASE WHEN _tagged IS NOT NULL THEN 'vnd' ELSE 'VND' END AS salary_currency,
  coalesce(_tagged IS NOT NULL AND {over}, false) AS salary_overflow"""


# --- the transformed postings as CTEs -------------------------------------
def transform_ctes() -> str:
    """CTEs raw -> tx (accepted, processed postings) -> tx_skills (exploded)."""
    ok = " AND ".join(f"coalesce(length({c}), 0) > 0"
                      for c in ["job_title", "job_description", "platform", "job_url"])
    return f"""raw AS ({derived_postings_sql()}),
acc AS (
  SELECT *, lower(job_title || ' ' || job_description) AS _t_td,
         lower(job_description || ' ' || job_title) AS _t_dt,
         {clean_description('job_description')} AS clean_description
  FROM raw WHERE {ok}),
s1 AS (SELECT *, {salary_columns('_t_td')} FROM acc),
s2 AS (SELECT *, {salary_finish()} FROM s1),
tx AS (
  SELECT ingest_seq, batch, platform, job_url, job_title,
    coalesce(nullif({label_value('clean_description', D.LABEL_COMPANY)}, ''), company) AS company_name,
    CASE WHEN nullif({label_value('clean_description', D.LABEL_LOCATION)}, '') IS NOT NULL
         THEN {canonical_location(label_value('clean_description', D.LABEL_LOCATION))}
         ELSE location END AS location,
    {posted_date('clean_description', 'posting_date')} AS posted_date,
    TRY_CAST(upper(scraped_at) AS TIMESTAMP) AS scraped_at,
    {seniority('_t_td')} AS seniority_level,
    {salary_final()},
    job_description AS raw_description, clean_description,
    {skills_list('_t_dt')} AS extracted_skills
  FROM s2),
tx_skills AS (
  SELECT ingest_seq, batch, job_url, s.skill_name, s.skill_category, s.pos
  FROM (SELECT ingest_seq, batch, job_url,
               unnest(list_transform(extracted_skills, lambda x, i: {{'skill_name': x.skill_name, 'skill_category': x.skill_category, 'pos': i}})) AS s
        FROM tx))"""


def with_tx(body: str, extra_ctes: bool = False) -> str:
    """``body`` is a final SELECT, or (extra_ctes) ", name AS (...) ... SELECT"."""
    sep = "" if extra_ctes else "\n"
    return f"WITH {transform_ctes()}{sep}{body}"


# --- star load (two batches) -------------------------------------------------
def star_ctes() -> str:
    """jobs / job_descriptions / skills / job_skills after loading batch 0 then 1,
    keyed by natural keys (job_url, skill_name)."""
    return f"""{transform_ctes()},
first_post AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY batch, ingest_seq) AS _rn FROM tx
  ) WHERE _rn = 1),
s_jobs AS (
  SELECT platform, job_url, job_title, company_name, location, posted_date, scraped_at,
         seniority_level, salary_min, salary_max, salary_currency FROM first_post),
s_desc AS (SELECT job_url, raw_description, clean_description FROM first_post),
s_skills AS (
  SELECT skill_name, skill_category FROM (
    SELECT skill_name, skill_category,
           row_number() OVER (PARTITION BY skill_name ORDER BY batch, ingest_seq, pos) AS _rn
    FROM tx_skills) WHERE _rn = 1),
s_links AS (SELECT DISTINCT job_url, skill_name FROM tx_skills)"""


def with_star(body: str) -> str:
    return f"WITH {star_ctes()}\n{body}"


# --- crawl frontier ----------------------------------------------------------
def frontier_sql() -> str:
    from ..sources import frontier as FR
    plat = pick("event_id % 3", D.PLATFORMS)
    crawl = f"(event_id // {FR.EVENTS_PER_CRAWL})"
    page = f"((event_id % {FR.EVENTS_PER_CRAWL}) // {FR.EVENTS_PER_PAGE} + 1)"
    return f"""SELECT CAST({crawl} AS BIGINT) AS crawl, {plat} AS platform, CAST({page} AS BIGINT) AS page,
  event_id AS pos, event_type = 'error' AS failed,
  'https://' || {plat} || '.example/job/u' || CAST(user_id AS VARCHAR) AS url,
  (({page} + {crawl}) % {FR.EMPTY_PAGE_MOD} = {FR.EMPTY_PAGE_REM}) AS page_empty,
  user_id AS "user"
FROM events"""


def listing_url_sql(platform: str, page: str, query: str) -> str:
    enc = py_quote_plus(query)
    enc20 = enc.replace("+", "%20")
    base = D.LIST_URL_BASE
    return (f"CASE WHEN {platform} = 'careerviet' THEN (CASE WHEN {page} = 1 "
            f"THEN {q(base['careerviet'] + '/' + enc + '-k-vi.html')} "
            f"ELSE {q(base['careerviet'] + '/' + enc + '-k-trang-')} || CAST({page} AS VARCHAR) || '-vi.html' END) "
            f"WHEN {platform} = 'topcv' THEN (CASE WHEN {page} = 1 THEN {q(base['topcv'] + '-' + enc)} "
            f"ELSE {q(base['topcv'] + '-' + enc + '?page=')} || CAST({page} AS VARCHAR) END) "
            f"ELSE (CASE WHEN {page} = 1 THEN {q(base['vieclam24h'] + 'q=' + enc20)} "
            f"ELSE {q(base['vieclam24h'] + 'page=')} || CAST({page} AS VARCHAR) || {q('&q=' + enc20)} END) END")


__all__ = ["q", "with_tx", "with_star", "frontier_sql", "listing_url_sql", "normalize_text",
           "clean_html", "truncate_text", "clean_description", "canonical_location"]


def strict_salary_select(text: str = "_t_td") -> str:
    """The strict salary reading (SQL twin of ``with_salary(strict=True)``).

    The Spark side strips thousands separators with a lookahead; RE2 has none,
    so here the number is split into its integer part (groups of three digits)
    and an optional 1-2 digit decimal part."""
    pats = SALARY_STRICT
    tagged = "coalesce(" + ", ".join(
        f"nullif('{i}' || regexp_extract({text}, {q(p)}, 0), '{i}')" for i, (p, _, _) in enumerate(pats)) + ")"
    idx = "CAST(substr(_tagged, 1, 1) AS INTEGER)"
    m = "substr(_tagged, 2)"

    def grp(g: int) -> str:
        whens = " ".join(f"WHEN {idx} = {i} THEN regexp_extract({m}, {q(p)}, {g})"
                         for i, (p, n, _) in enumerate(pats) if n >= g)
        return f"(CASE {whens} END)"

    def num(g: str) -> str:
        ip = f"regexp_extract({g}, '^([0-9]+(?:[.,][0-9]{{3}})*)', 1)"
        dp = f"regexp_extract({g}, '^[0-9]+(?:[.,][0-9]{{3}})*[.,]([0-9]{{1,2}})$', 1)"
        return (f"TRY_CAST(regexp_replace({ip}, '[.,]', '', 'g') || "
                f"CASE WHEN {dp} <> '' THEN '.' || {dp} ELSE '' END AS DOUBLE)")

    pair = " OR ".join(f"{idx} = {i}" for i, (_, n, _) in enumerate(pats) if n == 2)
    return f"""
, st1 AS (SELECT ingest_seq, {tagged} AS _tagged FROM acc),
st2 AS (SELECT ingest_seq, _tagged, {num(grp(1))} AS lo, {num(grp(2))} AS hi,
               (instr({m}, 'tr') > 0) AS has_tr, ({pair}) AS is_pair FROM st1),
st3 AS (SELECT *, CASE WHEN has_tr OR lo < 1000000 THEN lo * 1000000 ELSE lo END AS lo_s,
                  CASE WHEN has_tr OR lo < 1000000 THEN hi * 1000000 ELSE hi END AS hi_s FROM st2),
st4 AS (SELECT *, (_tagged IS NOT NULL AND abs(lo_s) < {LONG_MAX_D}) AS ok FROM st3)
SELECT ingest_seq,
  CASE WHEN ok THEN CAST(trunc(lo_s) AS BIGINT) END AS salary_min,
  CASE WHEN ok THEN (CASE WHEN is_pair THEN hi_s ELSE lo_s * 1.2 END) END AS salary_max,
  CASE WHEN _tagged IS NOT NULL THEN 'vnd' ELSE 'VND' END AS salary_currency,
  coalesce(_tagged IS NOT NULL AND NOT ok, false) AS salary_overflow
FROM st4"""
