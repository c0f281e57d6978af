"""What a column holds, told by its name: an ordered list of name patterns as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels in order of precedence with their LIKE patterns; ``_`` matches any character.
SEMANTIC_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("technical_identifier", ("%uuid%", "%guid%")),
    ("person_identifier", ("%empl%", "%employee%", "%staff%")),
    ("user_identifier", ("%user%", "%login%", "%account%")),
    ("organization_identifier", ("%dept%", "%business_unit%", "%org%")),
    ("technical_timestamp", ("%created%", "%updated%", "%modified%")),
    ("date_interval_boundary", ("%start%", "%end%")),
    ("date_part", ("%year%", "%month%", "%quarter%")),
    ("duration", ("%duration%", "%delay%", "%elapsed%")),
    ("date_or_timestamp", ("%dt", "%date%", "%time%", "%ts")),
    ("financial_amount", ("%amt%", "%amount%", "%bal%", "%salary%", "%price%", "%cost%", "%revenue%")),
    ("quantity", ("%qty%", "%count%", "%nbr%", "%nb%")),
    ("percentage_or_rate", ("%rate%", "%pct%", "%percent%", "%ratio%")),
    ("score", ("%score%", "%index%")),
    ("priority_level", ("%priority%", "%severity%")),
    ("status", ("%status%", "%stat%", "%state%")),
    ("classification", ("%type%", "%category%", "%class%")),
    ("email_address", ("%email%", "%mail%")),
    ("phone_number", ("%phone%", "%mobile%", "%tel%")),
    ("url", ("%url%", "%website%", "%link%")),
    ("postal_location", ("%postal%", "%zipcode%")),
    ("geo_latitude", ("%lat%",)),
    ("geo_longitude", ("%lon%", "%lng%")),
    ("person_first_name", ("%firstname%", "%given_name%")),
    ("person_last_name", ("%lastname%", "%surname%")),
    ("person_full_name", ("%fullname%", "%full_name%")),
    ("job_label", ("%job%", "%role%", "%position%")),
    ("source_system_reference", ("%source%", "%src%")),
    ("target_system_reference", ("%target%", "%tgt%")),
    ("file_reference", ("%file%", "%filename%", "%path%")),
    ("version_identifier", ("%version%", "%revision%")),
    ("processing_identifier", ("%batch%", "%run%", "%job%")),
    ("reference_identifier", ("%key%", "%code%", "%ref%")),
    ("identifier", ("%id", "id_%", "%_id")),
    ("label", ("%descr%", "%desc%", "%name%", "%label%")),
    ("comment_text", ("%comment%", "%remark%", "%note%")),
    ("location_text", ("%addr%", "%city%", "%country%")),
)
#: A label that a data type gives as well.
TYPE_RULES = {"date_or_timestamp": "date|timestamp|datetime|time"}


def column_semantics(name: Column, data_type: Column, rules=SEMANTIC_RULES, type_rules=TYPE_RULES) -> Column:
    """Label of the first rule that the lower-cased name (or the type) fits, else ``other``.

    The rules are tried inside a one-element transform: as generated code they are one method that is too long to be compiled,
    and each of them would work out the lower case again.
    """

    def first(x: Column) -> Column:
        chain = None
        for label, patterns in rules:
            fits = x["low"].like(patterns[0])
            for p in patterns[1:]:
                fits = fits | x["low"].like(p)
            if label in type_rules:
                fits = fits | x["kind"].rlike(type_rules[label])
            chain = F.when(fits, label) if chain is None else chain.when(fits, label)
        return F.lit("other") if chain is None else chain.otherwise("other")

    texts = F.struct(F.lower(F.coalesce(name, F.lit(""))).alias("low"), F.lower(F.coalesce(data_type, F.lit(""))).alias("kind"))
    return F.transform(F.array(texts), first)[0]


def semantics_sql(name: str, data_type: str) -> str:
    """The same cascade as a SQL expression."""
    whens = []
    for label, patterns in SEMANTIC_RULES:
        tests = [f"lower(coalesce({name}, '')) LIKE '{p}'" for p in patterns]
        if label in TYPE_RULES:
            tests.append(f"regexp_matches(lower(coalesce({data_type}, '')), '{TYPE_RULES[label]}')")
        whens.append(f"WHEN {' OR '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(whens)} ELSE 'other' END"
