"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver runs these on the same Parquet tables (registered as views) and
compares them with the Spark results. They restate the model semantics in plain
SQL: guards are full-match regexes, trims take spaces only, every sort names its
null order, and every dedupe carries the same total tie-break as the Spark side.
"""

from __future__ import annotations

# Fixed values, written out here once more so that the twins do not follow a
# mistake in the library's own constants. RE2's `$` matches only at the very end.
DATE_GUARD = r"^\d{4}-\d{2}-\d{2}$"
YEAR_GUARD = r"^\d{4}$"
RATING_GUARD = r"^\d+(\.\d+)?$"
TRUE_TOKENS = ("yes", "y", "true", "t", "1")
FALSE_TOKENS = ("no", "n", "false", "f", "0")
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
RATING_TEXTS = ("0.5", "1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5.0")
REVIEW_RATING_TEXTS = ("0.5", "1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5")
# The 43 declared checks: per table its columns, each with its checks.
_CHECKS = {
    ("bronze", "ratings"): "letterboxd_uri not_null unique, name not_null, rating not_null accepted_values",
    ("bronze", "watched"): "letterboxd_uri not_null unique, name not_null",
    ("bronze", "watchlist"): "letterboxd_uri not_null unique, name not_null",
    ("bronze", "diary"): "letterboxd_uri not_null, name not_null, watched_date not_null",
    ("bronze", "reviews"): "letterboxd_uri not_null, name not_null, rating accepted_values",
    ("bronze", "profile"): "username not_null unique",
    ("gold", "gold_top_rated_movies"):
        "letterboxd_uri not_null unique, name not_null, rating not_null accepted_values",
    ("gold", "gold_watchlist_by_year"): "year not_null unique, watchlist_count not_null",
    ("gold", "gold_lowest_rated_movie"):
        "letterboxd_uri not_null unique, name not_null, rating not_null accepted_values",
    ("gold", "gold_best_movie_year"): "year not_null unique, films_rated not_null, avg_rating not_null",
    ("gold", "gold_recent_watch"): "letterboxd_uri not_null unique, watched_date not_null, name not_null",
    ("gold", "gold_watch_activity"): "watch_month not_null unique, films_watched not_null",
}
DECLARED_CHECKS = [
    (layer, table, column.split()[0], check)
    for (layer, table), columns in _CHECKS.items()
    for column in columns.split(", ")
    for check in column.split()[1:]
]


def D(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


BRONZE_SQL = {
    "ratings": f"""
select case when l_linenumber = 7 then '  '
            when l_linenumber = 6 then concat({D('l_shipdate')}, 'T00')
            else concat(' ', {D('l_shipdate')}, ' ') end as list_date,
       case when l_partkey % 97 = 0 then '' else concat(' Film ', cast(l_partkey as varchar)) end as name,
       case when l_quantity = 13 then concat(cast(1950 + l_partkey % 75 as varchar), '.0')
            when l_quantity = 14 then ''
            else cast(1950 + l_partkey % 75 as varchar) end as year,
       case when l_partkey % 501 = 0 then ' '
            else concat('https://uri.test/f/', cast(l_partkey as varchar)) end as letterboxd_uri,
       case when l_discount > 0.095 then 'n/a'
            when l_discount < 0.005 then ''
            else concat(cast(cast(round(l_discount * 100) as integer) as varchar), '.',
                        cast(l_linenumber % 10 as varchar), '5') end as rating
from lineitem""",
    "diary": f"""
select case when o_orderkey % 10 = 0 then ''
            when o_orderkey % 10 = 1 then 'soon'
            when p = 2 then {D("o_orderdate + interval '1' day")}
            else {D('o_orderdate')} end as list_date,
       case when o_custkey % 89 = 0 then ' ' else concat('Film ', cast(o_custkey % 700 as varchar)) end as name,
       case when o_orderkey % 9 = 0 then '19x9' else cast(1950 + o_custkey % 70 as varchar) end as year,
       case when o_custkey % 251 = 0 then '   '
            else concat(' https://uri.test/d/', cast(o_custkey % 700 as varchar)) end as letterboxd_uri,
       case when o_orderkey % 6 = 0 then '' else concat(cast(o_orderkey % 5 as varchar), '.5') end as rating,
       case when o_orderstatus = 'F' then 'Yes'
            when o_orderstatus = 'O' then ' no '
            when o_orderkey % 2 = 0 then 'T'
            when o_orderkey % 3 = 0 then ''
            else 'maybe' end as rewatch,
       o_orderpriority as tags,
       case when o_orderkey % 12 = 0 then '2024/01/01' else {D('o_orderdate')} end as watched_date
from (select *, 1 as p from orders union all select *, 2 as p from orders) twice""",
    "reviews": f"""
select case when event_id % 10 = 0 then '' when event_id % 10 = 1 then 'soon' else {D('ts')} end as list_date,
       case when event_id % 83 = 0 then '' else concat('Film ', cast(user_id as varchar)) end as name,
       case when event_id % 9 = 0 then '2019.0' else cast(1950 + user_id % 70 as varchar) end as year,
       case when user_id % 50 = 0 then '  '
            else concat('https://uri.test/r/', cast(user_id as varchar)) end as letterboxd_uri,
       case when event_id % 6 = 0 then '-1' when event_id % 6 = 1 then '5'
            else concat(cast(event_id % 5 as varchar), '.5') end as rating,
       case when event_type = 'click' then 'Yes' when event_type = 'view' then ' FALSE '
            when event_type = 'purchase' then '1' when event_type = 'signup' then 'N'
            else '' end as rewatch,
       concat(' ', event_type, ' ') as review,
       props as tags,
       case when event_id % 12 = 0 then '' else {D('ts')} end as watched_date
from events""",
    "watchlist": f"""
select case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then '2024-1-1'
            else {D('o_orderdate')} end as list_date,
       concat('Film ', cast(o_custkey as varchar), ' ') as name,
       case when o_orderkey % 7 = 0 then 'n.d.' else cast(1950 + o_custkey % 70 as varchar) end as year,
       case when o_custkey % 401 = 0 then ''
            else concat('https://uri.test/w/', cast(o_custkey as varchar)) end as letterboxd_uri
from orders""",
    "profile": """
select case when c_custkey % 5 = 0 then '' when c_custkey % 5 = 1 then '1 Jan 2024'
            else concat('20', lpad(cast(c_custkey % 20 as varchar), 2, '0'), '-0',
                        cast(1 + c_custkey % 9 as varchar), '-15') end as date_joined,
       case when c_custkey % 301 = 0 then ' ' else concat('user', cast(c_custkey % 400 as varchar)) end as username,
       c_mktsegment as given_name,
       '' as family_name,
       concat(c_name, '@mail.test') as email_address,
       concat(' nation ', cast(c_nationkey as varchar)) as location,
       '  ' as website,
       c_name as bio,
       case when c_custkey % 2 = 0 then 'they' else '' end as pronoun,
       cast(c_custkey as varchar) as favorite_films
from customer""",
}
BRONZE_SQL["watched"] = BRONZE_SQL["watchlist"]

# --- scalar fragments -------------------------------------------------------


def clean(c: str) -> str:
    return f"nullif(trim(cast({c} as varchar), ' '), '')"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def guard_date(c: str) -> str:
    return f"case when regexp_matches({c}, '{DATE_GUARD}') then cast({c} as date) end"


def guard_year(c: str) -> str:
    return f"case when regexp_matches({c}, '{YEAR_GUARD}') then cast({c} as integer) end"


def guard_rating(c: str) -> str:
    return (
        f"case when regexp_matches({c}, '{RATING_GUARD}') "
        f"then cast({c} as decimal(3,1)) end"
    )


def to_bool(c: str) -> str:
    return (
        f"case when lower({c}) in ({_quoted(TRUE_TOKENS)}) then true "
        f"when lower({c}) in ({_quoted(FALSE_TOKENS)}) then false end"
    )


# --- silver ----------------------------------------------------------------

_FILM = ["list_date", "name", "year", "letterboxd_uri"]

# dataset -> (typed select list over cleaned columns, output columns, partition,
#             order, final filter)
_SILVER = {
    "ratings": (
        [guard_date("list_date") + " as list_date", "name", guard_year("year") + " as year",
         "letterboxd_uri", guard_rating("rating") + " as rating"],
        ["list_date", "name", "year", "letterboxd_uri", "rating"],
        ["letterboxd_uri", "list_date", "rating"],
        ["letterboxd_uri asc nulls last"],
        None,
    ),
    "watched": (
        [guard_date("list_date") + " as list_date", "name", guard_year("year") + " as year",
         "letterboxd_uri"],
        _FILM,
        ["letterboxd_uri"],
        ["list_date desc nulls last"],
        "letterboxd_uri is not null",
    ),
    "watchlist": (
        [guard_date("list_date") + " as list_date", "name", guard_year("year") + " as year",
         "letterboxd_uri"],
        _FILM,
        ["letterboxd_uri"],
        ["list_date desc nulls first"],
        None,
    ),
    "diary": (
        [guard_date("list_date") + " as list_date", "name", guard_year("year") + " as year",
         "letterboxd_uri", guard_rating("rating") + " as rating", to_bool("rewatch") + " as rewatch",
         "tags", guard_date("watched_date") + " as watched_date"],
        ["list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "tags", "watched_date"],
        ["letterboxd_uri", "watched_date", "rating"],
        ["list_date desc nulls last"],
        "letterboxd_uri is not null",
    ),
    "reviews": (
        [guard_date("list_date") + " as list_date", "name", guard_year("year") + " as year",
         "letterboxd_uri", guard_rating("rating") + " as rating", to_bool("rewatch") + " as rewatch",
         "review", "tags", guard_date("watched_date") + " as watched_date"],
        ["list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "review", "tags",
         "watched_date"],
        ["letterboxd_uri", "watched_date"],
        ["list_date desc nulls last"],
        "letterboxd_uri is not null",
    ),
    "profile": (
        [guard_date("date_joined") + " as date_joined", "username", "given_name", "family_name",
         "email_address", "location", "website", "bio", "pronoun", "favorite_films"],
        ["date_joined", "username", "given_name", "family_name", "email_address", "location",
         "website", "bio", "pronoun", "favorite_films"],
        ["username"],
        ["date_joined desc nulls last"],
        "username is not null",
    ),
}

_BRONZE_COLS = {
    "ratings": ["list_date", "name", "year", "letterboxd_uri", "rating"],
    "watched": _FILM,
    "watchlist": _FILM,
    "diary": ["list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "tags",
              "watched_date"],
    "reviews": ["list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "review",
                "tags", "watched_date"],
    "profile": ["date_joined", "username", "given_name", "family_name", "email_address",
                "location", "website", "bio", "pronoun", "favorite_films"],
}


def silver_typed_sql(dataset: str) -> str:
    typed, _, _, _, _ = _SILVER[dataset]
    cleaned = ", ".join(f"{clean(c)} as {c}" for c in _BRONZE_COLS[dataset])
    return (
        f"select {', '.join(typed)} from (select {cleaned} from ({BRONZE_SQL[dataset]}) b) src"
    )


def dedupe_sql(inner: str, columns: list[str], partition: list[str], order: list[str]) -> str:
    used = set(partition) | {o.split()[0] for o in order}
    ties = [f"{c} asc nulls last" for c in columns if c not in used]
    over = f"partition by {', '.join(partition)} order by {', '.join(order + ties)}"
    return (
        f"select {', '.join(columns)} from ({inner}) t "
        f"qualify row_number() over ({over}) = 1"
    )


def silver_sql(dataset: str) -> str:
    _, columns, partition, order, final = _SILVER[dataset]
    deduped = dedupe_sql(silver_typed_sql(dataset), columns, partition, order)
    if final:
        return f"select * from ({deduped}) d where {final}"
    return deduped


# --- gold ------------------------------------------------------------------


def mean_2dp(c: str) -> str:
    return (
        f"cast(cast((20 * sum(cast({c} * 10 as bigint)) + count({c})) // (2 * count({c})) "
        f"as decimal(18,0)) / 100 as decimal(5,2))"
    )


def gold_sql(name: str) -> str:
    r, d, w = silver_sql("ratings"), silver_sql("diary"), silver_sql("watchlist")
    if name == "gold_top_rated_movies":
        return (
            f"select name, year, rating, letterboxd_uri from ({r}) s where rating is not null "
            "order by rating desc nulls first, year desc nulls first, name asc nulls last, "
            "letterboxd_uri asc nulls last limit 10"
        )
    if name == "gold_lowest_rated_movie":
        return (
            f"select name, year, rating, letterboxd_uri from ({r}) s where rating is not null "
            "order by rating asc nulls last, year desc nulls first, name asc nulls last, "
            "letterboxd_uri asc nulls last limit 1"
        )
    if name == "gold_best_movie_year":
        return (
            f"select year, count(*) as films_rated, {mean_2dp('rating')} as avg_rating "
            f"from ({r}) s where rating is not null and year is not null "
            "group by year having count(*) >= 3 "
            "order by avg_rating desc, films_rated desc, year asc"
        )
    if name == "gold_recent_watch":
        return (
            "select name, year, watched_date, rating, rewatch, letterboxd_uri "
            f"from ({d}) s where watched_date is not null "
            "order by watched_date desc nulls first, name asc nulls last, "
            "letterboxd_uri asc nulls last, year asc nulls last, rating asc nulls last, "
            "rewatch asc nulls last limit 1"
        )
    if name == "gold_watch_activity":
        return (
            "select cast(date_trunc('month', watched_date) as date) as watch_month, "
            f"count(*) as films_watched from ({d}) s where watched_date is not null "
            "group by 1 order by 1"
        )
    if name == "gold_watchlist_by_year":
        return (
            "select year, count(*) as watchlist_count "
            f"from ({w}) s where year is not null group by year order by year"
        )
    raise KeyError(name)


def dedupe_only_sql(dataset: str) -> str:
    """W1 alone: typed rows, first per key, NULL keys kept."""
    _, columns, partition, order, _ = _SILVER[dataset]
    return dedupe_sql(silver_typed_sql(dataset), columns, partition, order)


# --- bronze load (B4-B6) -------------------------------------------------------

_NA = _quoted(NA_WORDS)


def bronze_rename_sql() -> str:
    """The ratings stand-in plus the unmapped export column ``Note``."""
    head, tail = BRONZE_SQL["ratings"].rsplit("\nfrom lineitem", 1)
    return f"{head},\n       l_returnflag as Note\nfrom lineitem{tail}"


def bronze_loaded_sql(dataset: str) -> str:
    cols = ", ".join(
        f"case when {c} in ({_NA}) then null else {c} end as {c}" for c in _BRONZE_COLS[dataset]
    )
    return f"select {cols} from ({BRONZE_SQL[dataset]}) b"


# --- scalar operators ------------------------------------------------------------


def scalar_sql(name: str) -> str:
    if name == "na_words":
        cols = _BRONZE_COLS["ratings"]
        raw = ", ".join(f"{c} as {c}_raw" for c in cols)
        mapped = ", ".join(f"case when {c} in ({_NA}) then null else {c} end as {c}" for c in cols)
        return f"select {raw}, {mapped} from ({BRONZE_SQL['ratings']}) b"
    if name == "clean_text":
        return f"select doc_id, {clean('text')} as text_clean from documents"
    if name == "guard_date":
        return (
            f"select {clean('watched_date')} as watched_date_txt, "
            f"{guard_date(clean('watched_date'))} as watched_date, "
            f"{clean('list_date')} as list_date_txt, {guard_date(clean('list_date'))} as list_date "
            f"from ({BRONZE_SQL['diary']}) b"
        )
    if name == "guard_year":
        return (
            f"select {clean('year')} as year_txt, {guard_year(clean('year'))} as year "
            f"from ({BRONZE_SQL['reviews']}) b"
        )
    if name == "guard_rating":
        return (
            f"select {clean('rating')} as rating_txt, {guard_rating(clean('rating'))} as rating "
            f"from ({BRONZE_SQL['ratings']}) b"
        )
    if name == "bool_tokens":
        return (
            f"select {clean('rewatch')} as rewatch_txt, {to_bool(clean('rewatch'))} as rewatch "
            f"from ({BRONZE_SQL['reviews']}) b"
        )
    if name == "month_start":
        return (
            "select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month_start "
            "from orders"
        )
    raise KeyError(name)


# --- raw zone --------------------------------------------------------------------

def _dataset_re() -> str:
    return r"(?:^|[_\- ])(diary|profile|ratings|reviews|watched|watchlist)\.csv$"


def infer_dataset(path: str) -> str:
    return f"nullif(regexp_extract(lower(string_split({path}, '/')[-1]), '{_dataset_re()}', 1), '')"


def _arr(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def export_files_sql() -> str:
    from reelhouse.standins import NAME_DATASETS, NAME_EXTS, NAME_SEPS

    path = (
        f"concat('in/', source, {_arr(NAME_SEPS)}[doc_id % {len(NAME_SEPS)} + 1], "
        f"{_arr(NAME_DATASETS)}[doc_id % {len(NAME_DATASETS)} + 1], "
        f"{_arr(NAME_EXTS)}[doc_id % {len(NAME_EXTS)} + 1])"
    )
    return (
        f"select doc_id, path, string_split(path, '/')[-1] as name, "
        f"cast(octet_length(encode(text)) as bigint) as length, text "
        f"from (select *, {path} as path from documents) d"
    )


def listing_sql() -> str:
    from reelhouse.standins import LISTING_DATASETS

    return (
        f"select concat('letterboxd/', cast(o_orderkey % 500 as varchar), '/', "
        f"cast(o_orderkey as varchar), '_', {_arr(LISTING_DATASETS)}[o_orderkey % 7 + 1], '.csv') as path, "
        "o_orderdate as modificationTime, cast(trunc(o_totalprice) as bigint) as length from orders"
    )


def uuid_from(*parts: str) -> str:
    h = f"sha256(concat_ws('/', {', '.join(parts)}))"
    return (
        f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
        f"substr({h}, 17, 4), substr({h}, 21, 12))"
    )


LEDGER_COLS = [
    "ingestion_id", "source", "original_filename", "bucket", "object_key", "size_bytes",
    "content_type", "status", "created_at", "updated_at",
]


def ledger_sql() -> str:
    from reelhouse.standins import LISTING_DATASETS

    return (
        f"select {uuid_from('cast(o_custkey as varchar)', 'o_orderpriority')} as ingestion_id, "
        f"'letterboxd_csv' as source, concat(ds, '.csv') as original_filename, "
        f"'raw' as bucket, "
        f"concat('letterboxd/', cast(o_custkey as varchar), '/', ds, '.csv') as object_key, "
        "cast(trunc(o_totalprice) as bigint) - 50000 as size_bytes, "
        "case when o_orderkey % 3 = 0 then null else 'text/csv' end as content_type, "
        f"'uploaded' as status, o_orderdate as created_at, o_orderdate as updated_at, o_orderstatus "
        f"from (select *, {_arr(LISTING_DATASETS[:6])}[o_orderkey % 6 + 1] as ds from orders) o"
    )


def raw_sql(name: str) -> str:
    if name == "infer_dataset":
        return f"select doc_id, name, {infer_dataset('path')} as dataset from ({export_files_sql()}) f"
    if name == "admit_files":
        return (
            "select doc_id, name, length, "
            "case when not suffix(lower(name), '.csv') then 'Only .csv files are supported' "
            "when length <= 0 then 'Empty file' end as reason, "
            "suffix(lower(name), '.csv') and length > 0 as admitted "
            f"from ({export_files_sql()}) f"
        )
    if name == "fingerprint":
        return (
            "select doc_id, cast(octet_length(encode(text)) as bigint) as size_bytes, "
            f"sha256(text) as sha256 from documents"
        )
    if name == "object_key":
        return (
            f"select o_orderkey, concat('letterboxd/', strftime(o_orderdate, '%Y/%m/%d/%H%M%S'), '_', "
            "left(sha256(cast(o_orderkey as varchar)), 12), '_', "
            "replace(concat('my ', o_orderpriority, ' export.csv'), ' ', '_')) as object_key "
            "from orders"
        )
    tagged = f"select *, {infer_dataset('path')} as dataset from ({listing_sql()}) l"
    if name == "latest_object":
        return (
            f"select path, modificationTime, length, dataset from ({tagged}) t "
            "where dataset is not null qualify row_number() over "
            "(partition by dataset order by modificationTime desc nulls last, path asc) = 1"
        )
    if name == "latest_by_suffix":
        return (
            f"select path, modificationTime, length from ({listing_sql()}) l "
            "where suffix(lower(path), 'ratings.csv') "
            "order by modificationTime desc nulls last, path asc limit 1"
        )
    if name == "available_datasets":
        return f"select distinct dataset from ({tagged}) t where dataset is not null"
    cols = ", ".join(LEDGER_COLS)
    if name == "recent_runs":
        ties = ", ".join(f"{c} asc nulls last" for c in LEDGER_COLS if c != "created_at")
        return (
            f"select {cols} from ({ledger_sql()}) l "
            f"order by created_at desc nulls first, {ties} limit 10"
        )
    if name == "insert_if_absent":
        ties = ", ".join(
            f"{c} asc nulls last" for c in LEDGER_COLS if c not in ("ingestion_id", "created_at")
        )
        return (
            f"with l as ({ledger_sql()}), "
            f"fresh as (select {cols} from l qualify row_number() over (partition by ingestion_id "
            f"order by created_at asc nulls last, {ties}) = 1) "
            "select * from fresh where not exists "
            "(select 1 from l where l.o_orderstatus = 'F' and l.ingestion_id = fresh.ingestion_id)"
        )
    if name == "check_ledger":
        nn = [
            "ingestion_id", "source", "original_filename", "bucket", "object_key", "size_bytes",
            "status", "created_at", "updated_at",
        ]
        parts = [
            f"select 'not_null' as check_name, '{c}' as column_name, "
            f"count(*) filter (where {c} is null) as failures from l"
            for c in nn
        ]
        parts.append(
            "select 'size_bytes_non_negative' as check_name, 'size_bytes' as column_name, "
            "count(*) filter (where size_bytes < 0) as failures from l"
        )
        parts.append(
            "select 'primary_key' as check_name, 'ingestion_id' as column_name, count(*) as failures "
            "from (select ingestion_id from l where ingestion_id is not null group by 1 "
            "having count(*) > 1) d"
        )
        parts.append(
            "select 'unique' as check_name, 'bucket,object_key' as column_name, count(*) as failures "
            "from (select bucket, object_key from l where bucket is not null and object_key is not null "
            "group by 1, 2 having count(*) > 1) d"
        )
        return f"with l as ({ledger_sql()}) " + " union all ".join(parts)
    raise KeyError(name)


# --- checks ----------------------------------------------------------------------


def check_sql(name: str) -> str:
    if name == "check_not_null":
        return f"select * from ({bronze_loaded_sql('ratings')}) b where name is null"
    if name == "check_unique":
        return (
            f"select letterboxd_uri, count(*) as n_records from ({silver_sql('ratings')}) s "
            "where letterboxd_uri is not null group by letterboxd_uri having count(*) > 1"
        )
    if name == "check_unique_by_load":
        return " union all ".join(
            f"select '{cols}' as column_name, count(*) as failures from (select {cols} from ({BRONZE_SQL['diary']}) b "
            f"where {' and '.join(f'{c} is not null' for c in cols.split(','))} group by {cols} having count(*) > 1) d"
            for cols in ("letterboxd_uri", "name,watched_date", "list_date")
        )
    if name == "check_accepted_text":
        vals = _quoted(RATING_TEXTS)
        return (
            f"select * from (select rating, count(*) as n_records from ({bronze_loaded_sql('ratings')}) b "
            f"group by rating) g where not (rating in ({vals}))"
        )
    if name == "check_accepted_number":
        vals = ", ".join(RATING_TEXTS)
        return (
            f"select * from (select rating, count(*) as n_records from ({silver_sql('ratings')}) s "
            f"group by rating) g where not (rating in ({vals}))"
        )
    if name == "check_suite":
        parts = []
        for layer, table, column, check in DECLARED_CHECKS:
            src = bronze_loaded_sql(table) if layer == "bronze" else gold_sql(table)
            head = (
                f"select '{layer}' as layer, '{table}' as table_name, "
                f"'{column}' as column_name, '{check}' as check_name, "
            )
            if check == "not_null":
                parts.append(f"{head} count(*) as failures from ({src}) t where {column} is null")
            elif check == "unique":
                parts.append(
                    f"{head} count(*) as failures from (select {column} from ({src}) t "
                    f"where {column} is not null group by 1 having count(*) > 1) d"
                )
            else:
                texts = REVIEW_RATING_TEXTS if table == "reviews" else RATING_TEXTS
                vals = _quoted(texts) if layer == "bronze" else ", ".join(texts)
                parts.append(
                    f"{head} count(*) as failures from (select {column} from ({src}) t "
                    f"group by 1) d where not ({column} in ({vals}))"
                )
        return " union all ".join(parts)
    raise KeyError(name)


# --- extra gold-level queries ------------------------------------------------------


def extra_sql(name: str) -> str:
    if name == "having_min_rows":
        return (
            f"select letterboxd_uri, count(*) as films_rated from ({silver_sql('ratings')}) s "
            "where letterboxd_uri is not null group by letterboxd_uri having count(*) >= 30"
        )
    if name == "row_counts":
        parts = []
        for ds in ("ratings", "watched", "watchlist", "diary", "reviews", "profile"):
            parts.append(
                f"select 'bronze' as layer, '{ds}' as table_name, count(*) as n "
                f"from ({bronze_loaded_sql(ds)}) b"
            )
            parts.append(
                f"select 'silver' as layer, 'silver_{ds}' as table_name, count(*) as n "
                f"from ({silver_sql(ds)}) s"
            )
        return " union all ".join(parts)
    if name == "ledger_rows":
        h = "sha256(concat('raw/letterboxd/', cast(o_orderkey as varchar), '.csv'))"
        at = "timestamp '2024-05-06 07:08:09'"
        return (
            f"select concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-', substr({h}, 13, 4), '-', "
            f"substr({h}, 17, 4), '-', substr({h}, 21, 12)) as ingestion_id, 'letterboxd_csv' as source, "
            "concat(o_orderpriority, ' export.csv') as original_filename, 'raw' as bucket, "
            "concat('letterboxd/', cast(o_orderkey as varchar), '.csv') as object_key, "
            "cast(o_custkey as bigint) as size_bytes, 'text/csv' as content_type, 'uploaded' as status, "
            f"{at} as created_at, {at} as updated_at from orders"
        )
    if name == "inferred_numeric_text":
        return (
            "select cast(o_orderkey as varchar) as id, cast(o_orderkey as varchar) as padded, "
            "case when o_orderkey % 3 <> 0 then concat(cast(o_orderkey as varchar), '0000000.0') end as holed, "
            "concat(cast(o_orderkey as varchar), '.5') as half, "
            "case when o_orderkey % 2 = 0 then 'True' else 'False' end as flag, "
            "o_orderpriority as word from orders"
        )
    if name == "latest_12_months":
        return (
            f"select * from ({gold_sql('gold_watch_activity')}) g "
            "order by watch_month desc nulls first limit 12"
        )
    if name == "latest_12_years":
        return (
            f"select * from ({gold_sql('gold_watchlist_by_year')}) g "
            "order by year desc nulls first limit 12"
        )
    raise KeyError(name)
