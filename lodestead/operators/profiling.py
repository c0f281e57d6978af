"""What a column holds, told by its values and its name: samples, patterns, semantics, masking.

Patterns and semantics are ordered rules over aggregates of the sample values, so they are
worked out by a group-by whatever the number of columns and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.rules import Rules, first_match, first_match_sql
from lodestead.functions.text import SPARK, Dialect

#: A value is cut to this many characters.
RENDERED = 64
#: Forms of a value.
FORMS = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$",
    "url": r"^(?:[hH][tT][tT][pP][sS]?://|[wW][wW][wW][.])",
    "phone": r"^[+]?[0-9][0-9 ().-]{6,}$",
    "uuid": r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "stamp": r"^(?:[0-9]{4}-(?:0?[1-9]|1[0-2])-(?:0?[1-9]|[12][0-9]|3[01])[T ]|[0-9]{4}/(?:0?[1-9]|1[0-2])/(?:0?[1-9]|[12][0-9]|3[01]) )(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9])?$",
    "day": r"^(?:[0-9]{4}[-/]?(?:0[1-9]|1[0-2])[-/]?(?:0[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[-/](?:0?[1-9]|1[0-2])[-/][0-9]{4})$",
    "flag": r"^(?:[yYnN01tTfF]|[yY][eE][sS]|[nN][oO]|[tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$",
    "integer": r"^[+-]?[0-9]+$",
    "decimal": r"^[+-]?[0-9]+(?:[.,][0-9]+)?$",
    "code": r"^[A-Z0-9_-]{2,12}$",
    "mixed": r"^[A-Za-z0-9_-]*(?:[A-Za-z][A-Za-z0-9_-]*[0-9]|[0-9][A-Za-z0-9_-]*[A-Za-z])[A-Za-z0-9_-]*$",
    "grade": r"^[A-Ea-e]$",
    "lower_start": r"(?:^|[^A-Za-z])[a-z]",
    "upper_inside": r"[A-Za-z][A-Z]",
    "letter": r"[A-Za-z]",
}
#: Patterns of observed values by the share of values with a form, in order.
OBSERVED: Rules = (
    ("email_like", "email >= 0.6"),
    ("url_like", "url >= 0.6"),
    ("phone_like", "phone >= 0.6"),
    ("uuid_like", "uuid >= 0.6"),
    ("timestamp_like", "stamp >= 0.6"),
    ("date_like", "day >= 0.6"),
    ("binary_flag_like", "flag = 1 AND kinds <= 2"),
    ("integer_like", "integer >= 0.75"),
    ("decimal_like", "decimal >= 0.75"),
    ("short_code_like", "code >= 0.7"),
    ("alphanumeric_identifier_like", "mixed >= 0.7"),
    ("name_like", "(mean_length > 28 OR spaced >= 0.7) AND spaced_title >= 0.5"),
    ("free_text_like", "mean_length > 28 OR spaced >= 0.7"),
    ("name_like", "title >= 0.6"),
    ("short_code_like", "grade >= 0.7"),
)
STATUS = "((contains(name, '_status_') OR contains(name, '_stat_')) OR (contains(name, '_sts_') AND (contains(name, '_cd_') OR contains(name, '_flg_'))))"


def has_token(*tokens: str) -> str:
    """Condition: ``name`` (a normalised name between underscores) has one of the tokens; a token of several words may stand anywhere."""
    return "(" + " OR ".join(f"contains(name, '{t if '_' in t else f'_{t}_'}')" for t in tokens) + ")"


def has_type(*words: str) -> str:
    return "(" + " OR ".join(f"contains(kind, '{w}')" for w in words) + ")"


NUMBERS = ("number", "int", "decimal", "numeric", "float", "double")
PLACE = has_token("address", "city", "country", "postal", "zip", "province", "county")
IDENTIFIER = "(name = '_id_' OR low LIKE '%!_id' ESCAPE '!' OR low LIKE 'id!_%' ESCAPE '!' OR contains(low, 'identifier'))"
#: Patterns told by name and type alone, in order.
NAMED_PATTERNS: Rules = (
    ("email_like", has_token("email", "mail")),
    ("phone_like", has_token("phone", "mobile", "tel")),
    ("url_like", has_token("url", "website", "link")),
    ("uuid_like", has_token("uuid", "guid")),
    ("timestamp_like", has_token("created", "updated", "modified", "dttm", "timestamp")),
    ("date_like", has_token("date", "dt", "effdt", "asof")),
    ("short_code_like", STATUS),
    ("short_code_like", has_token("code", "ref", "key")),
    ("name_like", has_token("name", "descr", "label", "title")),
    ("timestamp_like", has_type("timestamp")),
    ("date_like", has_type("date")),
    ("decimal_like", has_type(*NUMBERS)),
    ("short_code_like", has_type("char", "text", "clob")),
    ("free_text_like", "true"),
)
#: Words that both cascades below look for.
MONEY = has_token("amt", "amount", "bal", "price", "cost", "revenue", "salary", "monetary")
DURATION, RATE, SCORE = has_token("duration", "delay", "elapsed", "age"), has_token("pct", "percent", "rate", "ratio"), has_token("score", "index")
#: Semantics of people, texts and keys, in order.
PEOPLE: Rules = (
    ("person_identifier", has_token("emplid", "employee", "staff")),
    ("user_identifier", has_token("oprid", "userid", "user", "login", "account")),
    ("person_first_name", has_token("firstname", "first_name", "given_name")),
    ("person_last_name", has_token("lastname", "last_name", "surname")),
    ("person_full_name", has_token("fullname", "full_name", "contact_name", "person_name")),
    ("comment_text", has_token("comment", "note", "remark", "message", "descrlong")),
    ("label", has_token("descr", "label", "title", "name")),
)
KINDS: Rules = (
    ("status", STATUS),
    ("classification", has_token("type", "category", "class")),
    ("job_label", has_token("job", "role", "position")),
    ("processing_identifier", has_token("batch", "run", "process", "request", "workflow")),
)
KEYS: Rules = (("reference_identifier", has_token("ref", "code", "key")), ("identifier", IDENTIFIER))
#: Semantics told by the observed pattern and the name, in order; none where no rule holds.
OBSERVED_SEMANTICS: Rules = (
    ("geo_latitude", has_token("latitude", "lat")),
    ("geo_longitude", has_token("longitude", "lon", "lng")),
    ("postal_location", has_token("postal", "zipcode", "zip_code", "zip")),
    ("location_text", f"contains(name, '_state_') AND NOT {STATUS} AND {PLACE}"),
    ("other", f"contains(name, '_state_') AND NOT {STATUS}"),
    ("date_part", has_token("year", "month", "quarter", "week")),
    ("email_address", "pattern = 'email_like'"),
    ("phone_number", "pattern = 'phone_like'"),
    ("url", "pattern = 'url_like'"),
    ("technical_identifier", "pattern = 'uuid_like'"),
    ("flag", "pattern = 'binary_flag_like'"),
    ("technical_timestamp", f"pattern IN ('timestamp_like', 'date_like') AND {has_token('created', 'updated', 'modified', 'dttm', 'stamp', 'load')}"),
    ("date_or_timestamp", "pattern IN ('timestamp_like', 'date_like')"),
    *((label, f"pattern IN ('integer_like', 'decimal_like') AND {test}") for label, test in (
        ("duration", DURATION), ("percentage_or_rate", RATE), ("score", SCORE), ("financial_amount", MONEY),
        ("quantity", has_token("qty", "quantity", "count", "nbr", "num", "seq", "line", "rows")),
    )),
    *KINDS,
    *PEOPLE,
    ("technical_identifier", has_token("uuid", "guid")),
    *KEYS,
    ("date_or_timestamp", has_type("timestamp", "date")),
    ("identifier", "pattern = 'alphanumeric_identifier_like'"),
    ("classification", "pattern = 'short_code_like'"),
)
#: Semantics told by name and type alone, in order.
NAMED_SEMANTICS: Rules = (
    ("email_address", has_token("email", "mail")),
    ("phone_number", has_token("phone", "mobile", "tel")),
    ("url", has_token("url", "website", "link")),
    ("technical_identifier", has_token("uuid", "guid")),
    *KINDS,
    ("flag", has_token("flag", "enabled", "active", "is", "has")),
    ("date_part", has_token("year", "month", "quarter", "week")),
    ("technical_timestamp", has_token("created", "updated", "modified", "dttm", "stamp")),
    ("duration", DURATION),
    ("percentage_or_rate", RATE),
    ("score", SCORE),
    ("financial_amount", MONEY),
    ("quantity", has_token("qty", "quantity", "count", "nbr", "num", "seq")),
    ("postal_location", has_token("postal", "zipcode", "zip_code", "zip")),
    ("geo_latitude", has_token("latitude", "lat")),
    ("geo_longitude", has_token("longitude", "lon", "lng")),
    ("location_text", f"contains(name, '_state_') AND NOT {STATUS} AND {PLACE}"),
    ("other", f"contains(name, '_state_') AND NOT {STATUS}"),
    *PEOPLE,
    *KEYS,
    ("date_or_timestamp", has_type("date", "time")),
    ("quantity", has_type(*NUMBERS)),
    ("label", has_type("char", "text", "clob")),
    ("other", "true"),
)
#: Semantics whose values are masked, and the mask.
MASKED = (
    "email_address", "phone_number", "person_identifier", "person_first_name", "person_last_name", "person_full_name", "user_identifier", "postal_location",
    "geo_latitude", "geo_longitude",
)
MASK = "[*** masqué PII ***]"


def rendered_sql(x: str, d: Dialect, most: int = RENDERED) -> str:
    """White space as single spaces, ``|`` as ``/``, long values cut with three dots."""
    text = f"replace(trim({d.replace(x, '[ \t\r\n]+', ' ')}), '|', '/')"
    return f"CASE WHEN length({text}) > {most} THEN concat(left({text}, {most - 3}), '...') ELSE {text} END"


def name_columns(d: Dialect, name: str = "column_name", kind: str = "data_type") -> dict[str, str]:
    """``name`` between underscores, the lower-cased name and type that the rules read."""
    return {
        "name": f"concat('_', {d.replace(d.replace(f'lower(coalesce({name}, {chr(39) * 2}))', '[^a-z0-9]+', '_'), '^_+|_+$', '')}, '_')",
        "low": f"lower(coalesce({name}, ''))",
        "kind": f"lower(coalesce({kind}, ''))",
    }


def sample_column_values(df: DataFrame, keys: tuple[str, ...] = (), *, k: int = 4, columns: tuple[str, ...] | None = None) -> DataFrame:
    """``(keys, column_name, data_type, value)``: the first ``k`` distinct, non-blank rendered values of every column.

    Any type is read as text.  The rows are turned into (column, value) pairs and merged
    before they are ordered, and a group limit bounds what is ordered.
    """
    kinds = dict(df.dtypes)
    named = [c for c in (columns or df.columns) if c not in keys]
    wide = df.select(*keys, *[F.expr(rendered_sql(f"CAST(`{c}` AS STRING)", SPARK)).alias(c) for c in named])
    long = wide.unpivot(list(keys), named, "column_name", "value").where("trim(value) <> ''").distinct()
    order = Window.partitionBy(*keys, "column_name").orderBy("value")
    types = F.create_map(*[x for c in named for x in (F.lit(c), F.lit(kinds[c]))])
    first = long.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return first.select(*keys, "column_name", types[F.col("column_name")].alias("data_type"), "value")


def form_shares_sql(d: Dialect) -> dict[str, str]:
    """Aggregates of the sample values of a column that the rules read."""

    def share(test: str) -> str:
        return f"avg(CASE WHEN {test} THEN 1.0E0 ELSE 0.0E0 END)"

    own = {f: share(d.matches("value", p)) for f, p in FORMS.items() if f not in ("decimal", "mixed", "letter", "lower_start", "upper_inside")}
    title = f"{d.matches('value', FORMS['letter'])} AND NOT {d.matches('value', FORMS['lower_start'])} AND NOT {d.matches('value', FORMS['upper_inside'])}"
    return own | {
        "decimal": share(d.matches("replace(value, ' ', '')", FORMS["decimal"])),
        "mixed": share(f"length(value) >= 6 AND {d.matches('value', FORMS['mixed'])}"),
        "title": share(title),
        "spaced": share("contains(value, ' ')"),
        "spaced_title": share(f"contains(value, ' ') AND {title}"),
        "mean_length": "avg(CAST(length(value) AS DOUBLE))",
        "kinds": "count(DISTINCT upper(value))",
    }


def observed_patterns(samples: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys, column_name, data_type, pattern)`` by the sample values, or by the name where they tell nothing."""
    shares = samples.groupBy(*keys, "column_name", "data_type").agg(*[F.expr(sql).alias(n) for n, sql in form_shares_sql(SPARK).items()])
    named = shares.withColumns({n: F.expr(sql) for n, sql in name_columns(SPARK).items()})
    return named.select(*keys, "column_name", "data_type", F.coalesce(first_match(OBSERVED), first_match(NAMED_PATTERNS)).alias("pattern"))


def pattern_sql() -> str:
    return f"coalesce({first_match_sql(OBSERVED)}, {first_match_sql(NAMED_PATTERNS)})"


def merged_semantics(columns: DataFrame) -> DataFrame:
    """``columns(column_name, data_type, pattern, stored)`` with the column's semantics.

    The observed ones come first (``pattern`` is null where no value was seen), then those
    of the name unless they are *other*, then the stored ones, then *other*.
    """
    named = columns.withColumns({n: F.expr(sql) for n, sql in name_columns(SPARK).items()})
    return named.withColumn("semantics", F.expr(merged_sql())).drop("name", "low", "kind")


def merged_sql() -> str:
    return f"coalesce(CASE WHEN pattern IS NOT NULL THEN {first_match_sql(OBSERVED_SEMANTICS)} END, nullif({first_match_sql(NAMED_SEMANTICS)}, 'other'), nullif(stored, ''), 'other')"


def masked_samples(values: Column, semantics: Column, masked: tuple[str, ...] = MASKED, mask: str = MASK) -> Column:
    """The values as ``[a | b]``, or the mask where the semantics are of personal data."""
    return F.when(semantics.isin(*masked), mask).otherwise(F.concat(F.lit("["), F.array_join(values, " | "), F.lit("]")))


#: Prices in a page, by GB or by TB and month.
PER_GB, PER_TB = r"[$]([0-9]+(?:[.][0-9]+)?) */ *GB", r"[$]([0-9]+(?:[.][0-9]+)?) */ *TB"


def unit_price_sql(html: str, d: Dialect) -> str:
    """Yearly price of a GB in a page's text, or null: the price by GB, else that by TB."""
    text = d.replace(f"coalesce({html}, '')", "<[^>]*>", " ")
    gb, tb = d.extract(text, PER_GB), d.extract(text, PER_TB)
    return f"12 * coalesce(try_cast(nullif({gb}, '') AS DOUBLE), try_cast(nullif({tb}, '') AS DOUBLE) / 1024)"


def unit_prices(pages: DataFrame, html: str = "html", *, required: bool = False) -> DataFrame:
    """One row: least and greatest yearly price of a GB over all pages, and how many name one; with ``required`` no price is an error."""
    own = pages.select(F.expr(unit_price_sql(html, SPARK)).alias("price")).agg(F.min("price").alias("low"), F.max("price").alias("high"), F.count("price").alias("sources"))
    return own.where(F.when(F.col("sources") == 0, F.raise_error(F.lit("no page names a price")).isNull()).otherwise(F.lit(True))) if required else own


def salient_columns(fields: DataFrame, weights: dict[str, int], *, top: int = 24) -> DataFrame:
    """``(run_id, asset_id, salient)``: an asset's columns with the most points, best first; a column has the weight of its type, 1 for others."""
    points = F.coalesce(*[F.when(F.col("data_type") == t, F.lit(w)) for t, w in weights.items()], F.lit(1))
    own = fields.groupBy("run_id", "asset_id", "technical_name").agg(F.sum(points).alias("points"))
    order = Window.partitionBy("run_id", "asset_id").orderBy(F.desc("points"), "technical_name")
    best = own.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top)
    names = F.transform(F.array_sort(F.collect_list(F.struct("at", "technical_name"))), lambda s: s["technical_name"])
    return best.groupBy("run_id", "asset_id").agg(F.array_join(names, ", ").alias("salient"))
