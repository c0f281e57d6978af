"""Labels of other hands brought to one taxonomy: normalising, remapping, reply repair, metadata hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.rules import Rules, first_match_sql
from lodestead.functions.terms import counts, term_matches
from lodestead.functions.text import SPARK, Dialect, folded, module_prefix

#: Labels by the patterns of a folded raw label, in order; the last one is for all others.
LABEL_PATTERNS = (
    ("RH", r"\brh\b|ressources? humaines?|human resources?|\bhr\b"),
    ("Paie", r"\bpaie\b|payroll|remuneration|salaire"),
    ("Finance", r"finance|financier|compta|comptable|accounting|budget|tresorerie"),
    ("Achats", r"achat|procurement|purchas|approvisionnement|fournisseur"),
    ("Technique", r"techni|\bit\b|infra|systeme|system|admin|securite|security|data|etl|\bdb\b|base de donnees|devops|ops"),
)
UNKNOWN = "Inconnu"
#: Hint words of each domain.
HINTS = {
    "HR": ("hr", "human resources", "employee", "empl", "emplid", "payroll", "benefit", "job", "absence", "conge", "salaire"),
    "Finance": ("finance", "ledger", "account", "acct", "invoice", "payment", "budget", "journal", "asset", "depr", "tax", "ap", "ar", "gl"),
    "Sales": ("sales", "customer", "client", "crm", "opportunity", "quote", "deal", "booking"),
    "Procurement": ("procurement", "purchase", "purchasing", "supplier", "vendor", "rfq", "sourcing"),
    "Supply Chain": ("supply chain", "inventory", "stock", "shipment", "warehouse", "logistics", "delivery", "route"),
    "IT": ("it", "sysadm", "system", "security", "auth", "permission", "role", "user", "portal", "menu", "page", "config", "server", "prcs"),
    "Risk": ("risk", "control", "compliance", "incident", "mitigation", "policy"),
    "Marketing": ("marketing", "campaign", "lead", "segment", "audience", "conversion", "promo"),
}
#: Domains of module prefixes.
PREFIX_DOMAINS = {
    "Finance": ("GL", "AP", "AR", "AM", "BI", "TR", "EX"),
    "HR": ("HR", "JOB", "PERSON", "BEN", "PAY", "ABS", "COMP"),
    "Procurement": ("PO", "EP", "RFQ", "CON", "VND"),
    "Supply Chain": ("IN", "PL", "SF", "MG", "PROD"),
    "Sales": ("SA", "OM", "CRM"),
    "IT": ("PRCS", "PSAUTH", "PSOPR", "PSROLE", "PT", "PSMENU"),
}
#: Characters of a reason that are kept.
REASON_CHARS = 500


def label_rules(raw: str, d: Dialect) -> Rules:
    return tuple((label, d.matches(folded(raw, d), pattern)) for label, pattern in LABEL_PATTERNS) + ((UNKNOWN, "true"),)


def normalised_label(raw: str, d: Dialect = SPARK) -> str:
    """SQL of the label of the first pattern that a raw label has."""
    return first_match_sql(label_rules(raw, d))


def label_report(labelled: DataFrame, raw: str = "label_raw") -> DataFrame:
    """Rows by normalised label, with whether they are kept (all labels but the unknown one are)."""
    named = labelled.withColumn("label", F.expr(normalised_label(raw)))
    return named.groupBy("label").agg(F.count("*").alias("rows")).withColumn("kept", F.col("label") != UNKNOWN)


def label_column(df: DataFrame, hints: tuple[str, ...] = ("label", "domain", "category", "class"), *, most_kinds: int = 50) -> DataFrame:
    """The columns as candidates for holding a label, best first: hints in the name, filled values, few kinds.

    One aggregate over the table; what is ordered is a row per column.
    """
    kinds = [F.struct(F.lit(c).alias("column"), F.count(c).alias("filled"), F.approx_count_distinct(c).alias("kinds"), F.count("*").alias("rows")) for c in df.columns]
    out = df.agg(F.array(*kinds).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    named = F.lit(0)
    for h in hints:
        named = named + F.lower("column").contains(h).cast("int")
    points = 2 * named + F.try_divide("filled", "rows") + F.when((F.col("kinds") >= 2) & (F.col("kinds") <= most_kinds), 1).otherwise(0)
    return out.select("column", "filled", F.round(F.coalesce(points, F.lit(0.0)), 6).alias("points")).orderBy(F.desc("points"), "column")


def contained(texts: DataFrame, aliases: DataFrame, *, gram: int = 3) -> DataFrame:
    """``(text, alias, ...)`` of each distinct text and each alias that it contains, for ``aliases(alias, ...)``.

    Texts are posted under all their runs of up to ``gram`` characters, an alias only under the
    run of its own that fewest texts have; pairs that meet there are compared.  An empty or
    null alias is contained in nothing.
    """

    def runs(text: str, sizes: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(F.col(text), i, n)))))

    known = aliases.where(F.length("alias") > 0)
    posted = texts.select("text").distinct().where(F.length("text") > 0)
    posted = posted.select("text", F.explode(runs("text", F.sequence(F.lit(1), F.least(F.lit(gram), F.length("text"))))).alias("run"))
    frequent = posted.groupBy("run").agg(F.count("*").alias("n"))
    own = known.select("alias").distinct().select("alias", F.explode(runs("alias", F.array(F.least(F.lit(gram), F.length("alias"))))).alias("run"))
    # A run that no text has is the rarest of all, and its alias meets nothing.
    rarest = own.join(frequent, "run", "left").groupBy("alias").agg(F.min_by("run", F.struct(F.coalesce("n", F.lit(0)), "run")).alias("run"))
    return posted.join(rarest, "run").where(F.col("text").contains(F.col("alias"))).select("text", "alias").join(known, "alias")


def remapped(labelled: DataFrame, aliases: DataFrame, prefixes: DataFrame, known: DataFrame, *, label: str = "label_raw", name: str = "technical_name") -> DataFrame:
    """The label in the target taxonomy, how it was found, and whether a person should look.

    In order: ``known(prefix, target)`` corrects modules whatever their label, ``aliases
    (alias, target)`` maps a folded label as a whole, then the longest alias that it
    contains, then ``prefixes(prefix, target)`` by the name's module.  Containment is
    worked out for distinct labels only; the small tables are joined by their keys.
    """
    base = labelled.withColumns({"_folded": F.expr(folded(label, SPARK)), "_prefix": F.expr(module_prefix(name, SPARK))})
    whole = base.select("_folded").distinct().join(aliases.select(F.col("alias").alias("_folded"), F.col("target").alias("_whole")), "_folded", "left")
    inside = contained(whole.where("_whole is null").select(F.col("_folded").alias("text")), aliases)
    longest = inside.groupBy(F.col("text").alias("_folded")).agg(F.max_by("target", F.struct(F.length("alias"), "alias")).alias("_inside"))
    names = whole.join(longest, "_folded", "left")
    out = (
        base.join(names, "_folded", "left")
        .join(known.select(F.col("prefix").alias("_prefix"), F.col("target").alias("_known")), "_prefix", "left")
        .join(prefixes.select(F.col("prefix").alias("_prefix"), F.col("target").alias("_module")), "_prefix", "left")
    )
    status = F.when(F.col("_known").isNotNull(), "known_module").when(F.col("_whole").isNotNull(), "alias").when(F.col("_inside").isNotNull(), "contains_alias").when(F.col("_module").isNotNull(), "prefix").otherwise("unresolved")
    return out.select(*labelled.columns, F.coalesce("_known", "_whole", "_inside", "_module").alias("target"), status.alias("status"), status.isin("contains_alias", "prefix", "unresolved").alias("review"))


def hint_scores_sql(text: str, names: tuple[str, ...], d: Dialect) -> dict[str, str]:
    """SQL of the hits of each domain's hint words in a text, and two for each name whose module is the domain's: what `metadata_hint` scores."""
    out = {}
    for domain, words in HINTS.items():
        points = d.count(text, rf"\b(?:{'|'.join(words)})\b")
        prefixes = ", ".join(f"'{p}'" for p in PREFIX_DOMAINS.get(domain, ()))
        for name in names if prefixes else ():
            points += f" + CASE WHEN {module_prefix(name, d)} IN ({prefixes}) THEN 2 ELSE 0 END"
        out[domain] = f"CAST({points} AS BIGINT)"
    return out


def metadata_hint(dataset: DataFrame, *, least: int = 2) -> DataFrame:
    """Adds the domain that hints speak for, with the score, where one has enough and no other as many; else nulls."""
    text = "lower(concat_ws(' ', technical_name, source_ref, column_names_text, column_type_signature_text, column_value_semantics_text))"

    # Worked out once for all domains.
    modules = {f"_module_{name}": F.expr(module_prefix(name, SPARK)) for name in ("technical_name", "source_ref")}

    def prefix_points(domain: str) -> Column:
        prefixes = PREFIX_DOMAINS.get(domain, ())
        return sum((F.when(F.col(name).isin(*prefixes), 2).otherwise(0) for name in modules), F.lit(0)) if prefixes else F.lit(0)

    matched = dataset.withColumns({"_text": F.expr(text), **modules}).withColumn("_matches", term_matches(F.col("_text"), HINTS))
    points = {domain: n + prefix_points(domain) for domain, n in counts(F.col("_matches"), HINTS).items()}
    scored = matched.withColumn("_s", F.array_sort(F.array(*[F.struct((-n).alias("minus"), F.lit(k).alias("at"), F.lit(domain).alias("domain")) for k, (domain, n) in enumerate(points.items())])))
    top, second = -F.col("_s")[0]["minus"], -F.col("_s")[1]["minus"]
    sure = (top >= least) & (top > second)
    return scored.select("run_id", "asset_id", F.when(sure, F.col("_s")[0]["domain"]).alias("hint"), F.when(sure, F.concat(F.lit("top_score="), top.cast("string"))).alias("evidence"))


def repaired_reply(reply: Column, allowed: tuple[str, ...], other: str = "Other", *, reason_chars: int = REASON_CHARS) -> Column:
    """Struct of an annotator's label, confidence and reason from a reply with a JSON block in it.

    A label that is not allowed is ``other``; the confidence is a number between 0 and 1,
    or 0; a reply without a block gives ``other`` with 0.
    """
    block = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)(\{.*\})", 1)
    parsed = F.from_json(block, "business_domain string, confidence string, reason string", {"mode": "PERMISSIVE"})
    label, sure = F.trim(parsed["business_domain"]), F.coalesce(parsed["confidence"].try_cast("double"), F.lit(0.0))
    return F.struct(
        F.when(label.isin(*allowed), label).otherwise(other).alias("label"),
        F.when(F.isnan(sure), 0.0).otherwise(F.least(F.greatest(sure, F.lit(0.0)), F.lit(1.0))).alias("confidence"),
        F.left(F.trim(F.coalesce(parsed["reason"], F.lit(""))), F.lit(reason_chars)).alias("reason"),
    )


def raised_fallback(df: DataFrame, *, floor: float = 0.45) -> DataFrame:
    """Replies that say *Other* or little take the metadata hint, at no less than the floor."""
    weak = F.col("hint").isNotNull() & (F.col("label") == "Other")
    return df.withColumns({"label": F.when(weak, F.col("hint")).otherwise(F.col("label")), "confidence": F.when(weak, F.greatest("confidence", F.lit(floor))).otherwise(F.col("confidence"))})


def to_annotate(assets: DataFrame, done: DataFrame, key: str = "asset_id", *, legacy: str = "Other") -> DataFrame:
    """Assets without a label, and those whose label is the legacy one, which is asked for again."""
    kept = done.where((F.trim(F.coalesce("label", F.lit(""))) != "") & (F.col("label") != legacy))
    return assets.join(kept.select(key).distinct(), key, "left_anti")
