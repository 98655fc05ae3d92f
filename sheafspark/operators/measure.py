"""Cohort measures: definition, evaluation, report and flat report rows."""

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.params import typed_params
from sheafspark.functions.text import fmt_ratio, ratio
from sheafspark.operators.numbering import number_rows
from sheafspark.storage import written_table

# Strata of one row of a report.
PART_STRATA = 1_000

# Stratifiers counted in one scan; a grouping id has 64 bits.
STRATIFIERS_PER_SCAN = 48

# With more stratifiers, rows are looked at that tell how much combining equal ones first would save: from this share of
# different combinations on it saves nothing.
COMBINED_FROM, LOOKED_AT, WORTH = 4, 20_000, 0.5

# Fixed value: shown for a missing system, code or display.
MISSING = "–"


@dataclass
class Population:
    expression: str = ""
    code: str = ""


@dataclass
class Stratifier:
    code: str = ""
    expression: str = ""
    description: str = ""


@dataclass
class Group:
    population: list[Population] = field(default_factory=list)
    stratifier: list[Stratifier] = field(default_factory=list)
    type: str = ""
    code: str = ""
    description: str = ""


@dataclass
class Measure:
    group: list[Group] = field(default_factory=list)
    library: str = ""


def measure_from_dict(definition: dict) -> Measure:
    """Measure from the plain lists and dicts of a loaded definition file."""
    groups = []
    for entry in definition.get("group") or []:
        populations = [Population(**p) for p in entry.get("population") or []]
        stratifiers = [Stratifier(**s) for s in entry.get("stratifier") or []]
        texts = {k: v for k, v in entry.items() if k in ("type", "code", "description")}
        groups.append(Group(populations, stratifiers, **texts))
    return Measure(groups, definition.get("library") or "")


def validate_measure(measure: Measure) -> None:
    """Raises ``ValueError`` naming the place of the first missing part."""
    if not measure.group:
        raise ValueError("missing group")
    for g, group in enumerate(measure.group):
        at = f"error in group[{g}]: "
        if not group.population:
            raise ValueError(f"{at}missing population")
        for p, population in enumerate(group.population):
            if not population.expression:
                raise ValueError(f"{at}population[{p}]: missing expression name")
        for s, stratifier in enumerate(group.stratifier):
            if not stratifier.code:
                raise ValueError(f"{at}stratifier[{s}]: missing code")
            if not stratifier.expression:
                raise ValueError(f"{at}stratifier[{s}]: missing expression name")


def _check_names(tables, measure, library):
    """Raises ``ValueError`` naming the place of the first unknown basis or expression."""
    for g, group in enumerate(measure.group):
        at = f"error in group[{g}]: "
        if (group.type or "Patient") not in tables:
            raise ValueError(f"{at}unknown type `{group.type or 'Patient'}`")
        named = [(f"population[{i}]", p.expression) for i, p in enumerate(group.population)]
        named += [(f"stratifier[{i}]", s.expression) for i, s in enumerate(group.stratifier)]
        for place, expression in named:
            if expression not in library:
                raise ValueError(f"{at}{place}: unknown expression `{expression}`")


def _with_expressions(df, named, arguments):
    """Adds a column per ``name -> Column or SQL text``; SQL text may use ``:parameters``."""
    columns = {n: e for n, e in named.items() if isinstance(e, Column)}
    texts = {n: e for n, e in named.items() if not isinstance(e, Column)}
    rows = df.withColumns(columns) if columns else df
    if not texts:
        return rows
    select = ", ".join(f"({text}) AS `{n}`" for n, text in texts.items())
    # braces name the table only
    select = select.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT *, {select} FROM {{basis}}", args=arguments, basis=rows)


def _combinations_pay(members, strata):
    """Whether the members have few combinations of strata, judged by some of them; the counts are the same either way."""
    if len(strata) < COMBINED_FROM:
        return False
    some = members.select(F.struct(*strata).alias("s")).limit(LOOKED_AT)
    seen = some.agg(F.count("*").alias("rows"), F.count_distinct("s").alias("combinations")).first()
    return seen.combinations <= WORTH * seen.rows


def _basis_counts(df, groups, stratifiers, with_totals, library, arguments):
    """Counts of all groups over one basis in one scan.

    ``groups`` holds ``(number, group)``, ``stratifiers`` those to count as ``(number, position, stratifier)``.
    """
    populations = {(g, i): f"_p{g}_{i}" for g, group in groups for i in range(len(group.population))}
    strata = {(g, i): f"_s{g}_{i}" for g, i, _ in stratifiers}
    named = {populations[g, i]: library[p.expression] for g, group in groups for i, p in enumerate(group.population)}
    named |= {strata[g, i]: library[stratifier.expression] for g, i, stratifier in stratifiers}
    rows = _with_expressions(df, named, arguments)
    members = rows.where(reduce(or_, [F.col(p) for p in populations.values()])).select(
        *populations.values(), *[F.col(s).cast("string").alias(s) for s in strata.values()]
    )
    columns = [F.col(s) for s in strata.values()]
    counts = [F.count_if(p).alias(f"_n{p}") for p in populations.values()]
    numbers, nothing = list(populations.values()), F.lit(False)
    if _combinations_pay(members, list(strata.values())):
        # the grouping sets expand each row once for each stratifier: here each combination instead
        members = members.groupBy(*strata.values()).agg(*counts)
        numbers, nothing = [f"_n{p}" for p in numbers], F.lit(0).cast("bigint")
        counts = [F.sum(n).alias(n) for n in numbers]
    # a row of no population, so that a group without members still has its total of zero
    nobody = df.sparkSession.range(1).select(
        *[nothing.alias(n) for n in numbers], *[F.lit(None).cast("string").alias(s) for s in strata.values()]
    )
    everyone = members.unionByName(nobody)
    if columns:
        # the grouping id tells a null stratum from the total
        counted = everyone.groupingSets([[], *[[c] for c in columns]], *columns).agg(*counts, F.grouping_id().alias("_set"))
    else:
        counted = everyone.agg(*counts).withColumn("_set", F.lit(0).cast("bigint"))

    def results(g, group, position, code, stratum):
        return F.array(
            *[
                F.struct(
                    F.lit(g).alias("group_no"),
                    F.lit(group.code or None).cast("string").alias("group_code"),
                    F.lit(position).cast("int").alias("stratifier_no"),
                    F.lit(code).cast("string").alias("stratifier_code"),
                    stratum.cast("string").alias("stratum"),
                    F.lit(i).alias("population_no"),
                    F.col(f"_n{populations[g, i]}").alias("count"),
                )
                for i in range(len(group.population))
            ]
        )

    all_bits = (1 << len(strata)) - 1
    totals = [results(g, group, None, None, F.lit(None)) for g, group in groups] if with_totals else []
    shown = F.when(F.col("_set") == all_bits, F.concat(*totals)) if totals else None
    by_number = dict(groups)
    for n, (g, position, stratifier) in enumerate(stratifiers):
        group = by_number[g]
        # strata exist through members of their own group
        present = reduce(or_, [F.col(f"_n{populations[g, i]}") > 0 for i in range(len(group.population))])
        here = (F.col("_set") == (all_bits & ~(1 << (len(strata) - 1 - n)))) & present
        found = results(g, group, position, stratifier.code, F.col(strata[g, position]))
        shown = F.when(here, found) if shown is None else shown.when(here, found)
    return counted.select(F.inline(shown))


def evaluate_measure(
    tables: dict[str, DataFrame], measure: Measure, library: dict[str, Column | str], params: dict | None = None
) -> DataFrame:
    """Counts per group, stratifier, stratum and population; the group's own counts have no stratifier.

    ``tables`` maps a basis type to its rows; an empty group type means Patient.
    ``library`` maps expression names to columns or SQL text. Groups of one basis
    share a scan and an aggregate over grouping sets; with several stratifiers a few rows are looked at first, and where
    these have few combinations of strata, the sets are made of combinations. A null stratum is a stratum of its own.
    """
    validate_measure(measure)
    _check_names(tables, measure, library)
    arguments = typed_params(params or {})
    by_basis: dict[str, list] = {}
    for number, group in enumerate(measure.group):
        by_basis.setdefault(group.type or "Patient", []).append((number, group))
    parts = []
    for basis, groups in by_basis.items():
        stratifiers = [(g, i, s) for g, group in groups for i, s in enumerate(group.stratifier)]
        for start in range(0, max(len(stratifiers), 1), STRATIFIERS_PER_SCAN):
            some = stratifiers[start : start + STRATIFIERS_PER_SCAN]
            parts.append(_basis_counts(tables[basis], groups, some, start == 0, library, arguments))
    return reduce(DataFrame.unionByName, parts)


def measure_report(counts: DataFrame) -> DataFrame:
    """The counts as rows of a report: one for each group, and one for each stratifier and part of its strata.

    ``(group_no, group_code, population, stratifier_no, stratifier_code, strata, part, first_stratum, stratum)``. A group's
    own row has no stratifier. ``strata`` is how many the stratifier has, ``stratum`` the nested ones of the part, at most
    ``PART_STRATA``, numbered by value from ``first_stratum`` on; results of any size fit.
    """
    stored = written_table(counts, "measure-counts")
    keys = ["group_no", "group_code", "stratifier_no", "stratifier_code", "stratum"]
    # the definition bounds the populations
    pairs = F.array_sort(F.collect_list(F.struct("population_no", "count")))
    counted = stored.groupBy(*keys).agg(F.transform(pairs, lambda p: F.struct(p["count"].alias("count"))).alias("population"))
    heads = counted.where(F.col("stratifier_no").isNull()).select("group_no", "group_code", "population")
    numbered = number_rows(counted.where(F.col("stratifier_no").isNotNull()), ["stratum"], ["group_no", "stratifier_no"])
    value = F.struct(
        F.coalesce(F.col("stratum"), F.lit("null")).alias("text"),
        F.array().cast("array<struct<system: string, code: string, display: string>>").alias("coding"),
    )
    place = F.col("row_no") - 1
    part = F.floor(place / PART_STRATA)
    listed = F.array_sort(F.collect_list(F.struct(place.alias("n"), value.alias("value"), F.col("population"))))
    parts = numbered.groupBy("group_no", "stratifier_no", "stratifier_code", part.alias("part")).agg(
        F.transform(listed, lambda s: F.struct(s["value"].alias("value"), s["population"].alias("population"))).alias("stratum"),
        F.min(place).cast("int").alias("first_stratum"),
    )
    # one row per stratifier, and one per group, of the definition bounds the broadcasts
    sizes = numbered.groupBy("group_no", "stratifier_no").agg(F.count("*").alias("strata"))
    parts = parts.join(F.broadcast(sizes), ["group_no", "stratifier_no"]).join(F.broadcast(heads), "group_no")
    return heads.unionByName(parts, allowMissingColumns=True).select(
        "group_no", "group_code", "population", "stratifier_no", "stratifier_code", "strata", "part", "first_stratum", "stratum"
    )


def report_parts(reports: DataFrame) -> DataFrame:
    """Whole nested reports (column ``group``) in the form of ``measure_report``, next to the other columns."""
    keep = [c for c in reports.columns if c != "group"]
    groups = reports.select(*keep, F.posexplode("group").alias("group_no", "_group")).select(
        *keep,
        "group_no",
        F.col("_group.code.text").alias("group_code"),
        F.col("_group.population").alias("population"),
        F.col("_group.stratifier").alias("_stratifier"),
    )
    stratified = groups.select(
        *keep, "group_no", "group_code", "population", F.posexplode("_stratifier").alias("stratifier_no", "_s")
    )
    strata = F.coalesce(F.col("_s.stratum"), F.array())
    parts = stratified.select(
        *keep,
        "group_no",
        "group_code",
        "population",
        "stratifier_no",
        F.get(F.col("_s.code"), F.lit(0))["text"].alias("stratifier_code"),
        F.size(strata).cast("bigint").alias("strata"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(0).alias("first_stratum"),
        strata.alias("stratum"),
    )
    return groups.drop("_stratifier").unionByName(parts, allowMissingColumns=True)


def _is_null_text(text):
    return text.isNull() | (text == "null")


def _title(code_text):
    return F.coalesce(F.nullif(code_text, F.lit("")), F.lit("Group"))


def report_rows(report: DataFrame) -> DataFrame:
    """Flat rows of the rows of reports, next to their other columns; nested reports come from ``report_parts``.

    ``kind`` is ``group`` for the head of a group, ``nothing`` for a stratifier
    whose only stratum is null, ``coding`` for one row per coding of a stratum
    (count and ratio on the first only), or ``text`` for a stratum without codings.
    """
    own = "group_no group_code population stratifier_no stratifier_code strata part first_stratum stratum".split()
    keep = [c for c in report.columns if c not in own]
    none = F.lit(None).cast("string")
    dash = F.lit(MISSING)

    def row(kind, stratum_no, coding_no, system, code, display, count):
        return F.struct(
            F.lit(kind).alias("kind"),
            F.col("stratifier_no").cast("int").alias("stratifier_no"),
            F.col("stratifier_code").alias("stratifier"),
            stratum_no.cast("int").alias("stratum_no"),
            coding_no.cast("int").alias("coding_no"),
            system.alias("system"),
            code.alias("code"),
            display.alias("display"),
            count.cast("bigint").alias("count"),
        )

    def shown(text):
        return F.coalesce(F.nullif(text, F.lit("")), dash)

    def rows_of(stratum, i):
        value = stratum["value"]
        count = F.get(stratum["population"], F.lit(0))["count"]
        number = i + F.col("first_stratum")
        codings = F.transform(
            value["coding"],
            lambda c, k: row(
                "coding", number, k, shown(c["system"]), shown(c["code"]), shown(c["display"]), F.when(k == 0, count)
            ),
        )
        texts = F.array(row("text", number, F.lit(0), dash, dash, value["text"], count))
        no_rows = F.slice(texts, 1, 0)
        return (
            F.when(value.isNull(), no_rows)
            .when(F.coalesce(F.size(value["coding"]), F.lit(0)) > 0, codings)
            .when(_is_null_text(value["text"]), no_rows)
            .otherwise(texts)
        )

    only = F.get("stratum", F.lit(0))["value"]
    nothing = (F.col("strata") == 1) & _is_null_text(only["text"]) & (F.coalesce(F.size(only["coding"]), F.lit(0)) <= 0)
    head = F.array(row("group", F.lit(None), F.lit(0), none, none, none, F.lit(None)))
    rows = (
        F.when(F.col("stratifier_no").isNull(), head)
        .when(nothing, F.array(row("nothing", F.lit(None), F.lit(0), none, none, F.lit("nothing"), F.lit(None))))
        .otherwise(F.flatten(F.transform("stratum", rows_of)))
    )
    flat = report.select(
        *keep,
        (F.col("group_no") + 1).alias("group_no"),
        _title(F.col("group_code")).alias("group_title"),
        F.get("population", F.lit(0))["count"].alias("group_count"),
        F.explode(rows).alias("_row"),
    )
    return _with_ratio(flat.select(*keep, "group_no", "group_title", "group_count", "_row.*"))


def _with_ratio(rows):
    percent = ratio(F.col("count"), F.col("group_count"))
    return rows.withColumn("ratio", percent).withColumn("ratio_text", fmt_ratio(percent))


def stratum_ratios(counts: DataFrame) -> DataFrame:
    """Strata of the first population with their ratio to the group's count.

    The group side has one row per group of the definition, which bounds its broadcast.
    """
    # stored, so that strata and groups do not evaluate the measure twice
    first = written_table(counts.where(F.col("population_no") == 0), "measure-counts")
    groups = first.where(F.col("stratifier_no").isNull()).select("group_no", F.col("count").alias("group_count"))
    strata = first.where(F.col("stratifier_no").isNotNull()).drop("population_no")
    return _with_ratio(strata.join(F.broadcast(groups), "group_no"))


def stratum_rows(counts: DataFrame) -> DataFrame:
    """The rows of ``report_rows`` straight from the counts, for any number of strata."""
    strata = stratum_ratios(counts)
    numbered = number_rows(strata, ["stratum"], ["group_no", "stratifier_no"])
    sizes = numbered.groupBy("group_no", "stratifier_no").agg(F.count("*").alias("_strata"))
    # one row per stratifier of the definition bounds the broadcast
    rows = numbered.join(F.broadcast(sizes), ["group_no", "stratifier_no"])
    null = _is_null_text(F.col("stratum"))
    nothing = null & (F.col("_strata") == 1)
    return rows.where(~null | nothing).select(
        (F.col("group_no") + 1).alias("group_no"),
        _title(F.col("group_code")).alias("group_title"),
        "group_count",
        F.when(nothing, F.lit("nothing")).otherwise(F.lit("text")).alias("kind"),
        "stratifier_no",
        F.col("stratifier_code").alias("stratifier"),
        F.when(~nothing, F.col("row_no") - 1).cast("int").alias("stratum_no"),
        F.when(nothing, F.lit("nothing")).otherwise(F.col("stratum")).alias("display"),
        F.when(~nothing, F.col("count")).alias("count"),
        F.when(~nothing, F.col("ratio")).alias("ratio"),
        F.when(~nothing, F.col("ratio_text")).alias("ratio_text"),
    )
