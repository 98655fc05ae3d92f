"""Operation outcomes: classification and the text shown to users."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafspark.functions.json_text import using
from sheafspark.functions.text import indent_except_first
from sheafspark.schemas import ISSUE, OUTCOME

# Issue codes after which the same request may be sent again.
TRANSIENT_CODES = ["transient", "lock-error", "no-store", "timeout", "incomplete", "throttled"]

# Issue severities and their display texts (public FHIR value set).
SEVERITY_DISPLAY = {
    "fatal": "Fatal",
    "error": "Error",
    "warning": "Warning",
    "information": "Information",
}

# Issue types and their definitions (public FHIR value set).
CODE_DEFINITION = {
    "invalid": "Content invalid against the specification or a profile.",
    "structure": "A structural issue in the content such as wrong namespace, unable to parse the content completely, invalid syntax, etc.",
    "required": "A required element is missing.",
    "value": "An element or header value is invalid.",
    "invariant": "A content validation rule failed - e.g. a schematron rule.",
    "security": "An authentication/authorization/permissions issue of some kind.",
    "login": "The client needs to initiate an authentication process.",
    "unknown": "The user or system was not able to be authenticated (either there is no process, or the proferred token is unacceptable).",
    "expired": "User session expired; a login may be required.",
    "forbidden": "The user does not have the rights to perform this action.",
    "suppressed": "Some information was not or might not have been returned due to business rules, consent or privacy rules, or access permission constraints.  This information may be accessible through alternate processes.",
    "processing": "Processing issues. These are expected to be final e.g. there is no point resubmitting the same content unchanged.",
    "not-supported": "The interaction, operation, resource or profile is not supported.",
    "duplicate": "An attempt was made to create a duplicate record.",
    "multiple-matches": "Multiple matching records were found when the operation required only one match.",
    "not-found": "The reference provided was not found. In a pure RESTful environment, this would be an HTTP 404 error, but this code may be used where the conflict is discovered further into the application architecture.",
    "deleted": "The reference pointed to content (usually a resource) that has been deleted.",
    "too-long": "Provided content is too long (typically, this is a denial of service protection type of error).",
    "code-invalid": "The code or system could not be understood, or it was not valid in the context of a particular ValueSet.code.",
    "extension": "An extension was found that was not acceptable, could not be resolved, or a modifierExtension was not recognized.",
    "too-costly": "The operation was stopped to protect server resources; e.g. a request for a value set expansion on all of SNOMED CT.",
    "business-rule": "The content/operation failed to pass some business rule and so could not proceed.",
    "conflict": "Content could not be accepted because of an edit conflict (i.e. version aware updates). (In a pure RESTful environment, this would be an HTTP 409 error, but this code may be used where the conflict is discovered further into the application architecture.).",
    "transient": "Transient processing issues. The system receiving the message may be able to resubmit the same content once an underlying issue is resolved.",
    "lock-error": "A resource/record locking failure (usually in an underlying database).",
    "no-store": "The persistent store is unavailable; e.g. the database is down for maintenance or similar action.",
    "exception": "An unexpected internal error has occurred.",
    "timeout": "An internal timeout has occurred.",
    "incomplete": "Not all data sources typically accessed could be reached or responded in time, so the returned information might not be complete (applies to search interactions and some operations).",
    "throttled": "The system is not prepared to handle this request due to load management.",
    "informational": "A message unrelated to the processing success of the completed operation (examples of the latter include things like reminders of password expiry, system maintenance times, etc.).",
}


def _lookup(table, key):
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[key], key)


def _line(label, value):
    """One labelled line, or nothing for a missing or empty value."""
    return F.when(
        F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label:<12}: "), value, F.lit("\n"))
    ).otherwise(F.lit(""))


def parse_outcome(text: Column) -> Column:
    return F.from_json(text, OUTCOME)


def read_outcome(text: Column) -> Column:
    """Struct of ``readable`` and ``issue``.

    An outcome is an object that decodes as a whole and has the outcome's type, or no type but issues.
    """
    parsed = F.from_json(text, f"{OUTCOME}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})

    def judged(p):
        typed = (p["resourceType"] == "OperationOutcome") | (p["resourceType"].isNull() & p["issue"].isNotNull())
        readable = F.coalesce(text.rlike(r"^\s*\{") & p["_corrupt"].isNull() & typed, F.lit(False))
        issues = F.coalesce(p["issue"], F.array().cast(f"ARRAY<{ISSUE}>"))
        return F.struct(readable.alias("readable"), F.when(readable, issues).alias("issue"))

    return using(parsed, judged)


def is_transient(issue: Column) -> Column:
    return F.coalesce(issue["code"].isin(TRANSIENT_CODES), F.lit(False))


def is_retryable(issues: Column) -> Column:
    """True if any issue of the outcome is transient."""
    return F.coalesce(F.exists(issues, is_transient), F.lit(False))


def fmt_issue(issue: Column) -> Column:
    details = issue["details"]
    codes = F.filter(F.transform(details["coding"], lambda c: c["code"]), lambda c: F.coalesce(c, F.lit("")) != "")
    code_lines = F.array_join(F.transform(codes, lambda c: _line("Details", c)), "")
    return F.concat(
        _line("Severity", _lookup(SEVERITY_DISPLAY, F.coalesce(issue["severity"], F.lit("fatal")))),
        _line("Code", _lookup(CODE_DEFINITION, F.coalesce(issue["code"], F.lit("invalid")))),
        _line("Details", details["text"]),
        F.coalesce(code_lines, F.lit("")),
        _line("Diagnostics", issue["diagnostics"]),
        _line("Expression", F.array_join(issue["expression"], ", ")),
    )


def fmt_outcome(issues: Column) -> Column:
    """The issues of one outcome, separated by ``---`` lines."""
    return F.coalesce(F.array_join(F.transform(issues, fmt_issue), "---\n"), F.lit(""))


def fmt_outcomes(outcomes: Column) -> Column:
    """Several outcomes (an array of structs with ``issue``), separated likewise."""
    return F.array_join(F.transform(outcomes, lambda o: fmt_outcome(o["issue"])), "---\n")


def fmt_error_response(status: Column, issues: Column, other_error: Column) -> Column:
    return F.concat(
        F.lit("StatusCode  : "),
        status.cast("string"),
        F.lit("\n"),
        fmt_outcome(issues),
        _line("Error", indent_except_first(14, other_error)),
    )
