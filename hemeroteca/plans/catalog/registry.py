"""Registration of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemeroteca.functions import fixed_values as fv
from hemeroteca.plans import inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function under its own name, with the SQL its result must equal."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if check is not None:
            ORACLES[fn.__name__] = check
        return fn

    return register


# --- the derived input tables, for the checking engine ------------------------------


def articles_sql(body: str = inputs.GLUED_TEXT) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in inputs.ARTICLE_COLUMNS.items())
    return f"(SELECT {columns}, {body.format(t='text')} AS body FROM documents)"


LISTING_SQL = f"""(SELECT doc_id AS idx, {inputs.article_url(f'({inputs.LISTING_KEY})')} AS url,
    {inputs.ARTICLE_COLUMNS['title']} AS title, {inputs.ARTICLE_COLUMNS['page']} AS page, doc_id AS pos FROM documents)"""

ORDER_URLS_SQL = f"""(SELECT o_orderkey AS idx, {inputs.article_url('o_orderkey')} AS url, o_orderstatus AS status,
    o_orderdate AS listed_at, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE NULL END AS date FROM orders)"""


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{fv.WS_SPELT_OUT}+', ' ', 'g'))"


def unglue_sql(x: str, rules: str) -> str:
    for pattern, replacement in fv.GLUE_RULES[rules]:
        x = f"regexp_replace({x}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return squeeze_sql(x)


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def replaced_sql(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {_quoted(old)}, {_quoted(new)})"
    return x


_ENTITIES = (
    ("&eacute;", "é"), ("&nbsp;", "\u00a0"), ("&#100;", "d"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&copy;", "©"), ("&middot;", "·"),
)


def decoded_sql(x: str) -> str:
    """The entities that occur in the inputs, the ampersand last; it counts without its semicolon too."""
    return f"regexp_replace({replaced_sql(x, _ENTITIES)}, '&amp;?', '&', 'g')"


# The two published patterns of glued words, for the checking engine.
SUSPECTS_SQL = r"""list_concat(list_filter(regexp_extract_all(lower(body), '[\p{L}\p{N}_]+'),
    lambda w: regexp_matches(w, '^[a-záéíóúñ]{20,}$')), regexp_extract_all(body, '[a-záéíóúñ]+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+'))"""
