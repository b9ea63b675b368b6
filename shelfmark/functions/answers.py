"""Column expressions around model requests and answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import strip

ANSWER_FIELDS = ("deployment_type", "deployment_reason", "cloud_provider", "cloud_reason")
ANSWER_LINES = ("DEPLOYMENT:", "DEPLOYMENT_REASON:", "CLOUD:", "CLOUD_REASON:")
_BLANK = r"[\t\x0b-\r\x1c-\x20\x{85}\p{Z}]"

# The part of an answer that names a type or a provider, in test order.
TYPE_MARKS = (("Batch", ("batch",)), ("Streaming", ("stream",)), ("Web Service", ("web", "service")))
CLOUD_MARKS = (
    ("GCP", ("gcp", "google")), ("AWS", ("aws", "amazon")), ("Azure", ("azure",)),
    ("Unknown", ("unknown",)),
)
# Fixed value: the reason given where a model did not answer.
NO_RESPONSE = "LLM returned no response"
ALL_TYPES = ("Batch", "Streaming", "Web Service")

# What a model is told about each type; a deployment may pass its own wording.
TYPE_HELP = {
    "Batch": "Batch: scheduled or orchestrated jobs that load and transform data periodically",
    "Streaming": "Streaming: data flows continuously through a message broker or stream processor",
    "Web Service": "Web Service: results or a trained model are served through an API or web app",
}
BATCH_HINT = "The project works in BATCH: do not use 'Real-Time', 'Streaming' or 'Live' in a title."
STREAM_HINT = "The project is STREAMING: 'Real-Time' or 'Streaming' may be used where it fits."


def _mentions(value: Column, marks: Sequence[str]) -> Column:
    test = value.contains(marks[0])
    for mark in marks[1:]:
        test = test | value.contains(mark)
    return test


def last_line(response: Column, prefix: str) -> Column:
    """The last line that begins with the prefix, blanks before it ignored; '' when there is none.

    A greedy pattern finds it without splitting the answer into lines; it is tied
    to the beginning, so a missing line costs one look through the text.
    """
    return F.regexp_extract(response, rf"(?s)^(?:.*\n)?{_BLANK}*+({prefix}[^\n]*)", 1)


def line_value(line: Column, prefix: str) -> Column:
    return strip(F.replace(line, F.lit(prefix), F.lit("")))


def types_named(deployment_line: Column) -> Column:
    """'Unknown', or the types an answer names, in fixed order."""
    value = F.lower(line_value(deployment_line, ANSWER_LINES[0]))
    types = F.concat_ws(
        ", ", *[F.when(_mentions(value, marks), label) for label, marks in TYPE_MARKS]
    )
    return F.when(types == "", "Unknown").otherwise(types)


def provider_named(cloud_line: Column) -> Column:
    """The provider an answer names; a name that is none of the known ones stays as it is."""
    value = line_value(cloud_line, ANSWER_LINES[2])
    low = F.lower(value)
    provider = value
    for label, marks in reversed(CLOUD_MARKS):
        provider = F.when(_mentions(low, marks), label).otherwise(provider)
    return F.when(cloud_line == "", "Unknown").otherwise(provider)


def reason_given(line: Column, prefix: str) -> Column:
    return F.when(line == "", "Unknown").otherwise(line_value(line, prefix))


def outside_types(deployment: Column, valid: Column) -> Column:
    """Whether an answer names a type its course does not list; answers are not filtered by it."""
    named = F.filter(F.split(deployment, ", "), lambda t: t != "Unknown")
    return F.size(F.array_except(named, valid)) > 0


def title_hint(deployment: Column) -> Column:
    low = F.lower(deployment)
    return (
        F.when(F.coalesce(low, F.lit("")) == "", "")
        .when(low.contains("streaming"), STREAM_HINT)
        .otherwise(BATCH_HINT)
    )


def title_prompt(url: Column, summary: Column, deployment: Column | None = None) -> Column:
    hint = title_hint(deployment) if deployment is not None else F.lit("")
    return F.concat(
        F.lit(
            "Propose 5 different titles of 3 to 5 words for the project below, one per line.\n"
            "Name its data domain and what it does; leave out course names, filler words and "
            "technology the summary does not mention.\n"
        ),
        hint,
        F.lit("\nProject URL: "), url,
        F.lit("\nProject summary: "), summary,
        F.lit("\nTitles:"),
    )


def summary_prompt(content: Column) -> Column:
    return F.concat(
        F.lit("Describe purpose and key features of this repository in two sentences:\n"), content
    )


def classification_prompt(
    url: Column, content: Column, valid: Column, type_help: Mapping[str, str] = TYPE_HELP
) -> Column:
    """Asks for the four answer lines, among the types valid for the row's course."""
    described = F.transform(valid, lambda t: _described(t, type_help))
    return F.concat(
        F.lit("Classify the repository by its code and configuration.\nREPOSITORY URL: "), url,
        F.lit("\nFILES:\n"), content,
        F.lit("\nDEPLOYMENT TYPE, one of "), F.array_join(valid, ", "), F.lit(", Unknown:\n- "),
        F.array_join(described, "\n- "),
        F.lit(
            "\nName both types of a mixed project. A dashboard alone is not Streaming.\n"
            "CLOUD PROVIDER: GCP, AWS, Azure, another one, or Unknown.\n"
            "Answer in exactly these lines:\nDEPLOYMENT: <types>\nDEPLOYMENT_REASON: <reason>\n"
            "CLOUD: <provider>\nCLOUD_REASON: <reason>"
        ),
    )


def _described(t: Column, type_help: Mapping[str, str]) -> Column:
    text = t
    for label, help_text in type_help.items():
        text = F.when(t == label, help_text).otherwise(text)
    return text


def summary_of(response: Column) -> Column:
    return F.coalesce(strip(response), F.lit(""))


def decoded_payload(content: Column, kind: Column | None = None, n: int = 8000) -> Column:
    """Text of a base64 payload, invalid UTF-8 replaced, cut to n characters.

    Null for anything but a non-empty file, and for broken base64.
    """
    text = F.substring(F.make_valid_utf8(_bytes(content).cast("string")), 1, n)
    usable = F.length(content) > 0
    if kind is not None:
        usable = usable & (kind == "file")
    return F.when(usable, text)


def strictly_decoded(content: Column) -> Column:
    """Whole text of a base64 payload; null when the base64 or the UTF-8 is broken."""
    return F.try_validate_utf8(_bytes(content).cast("string"))


def _bytes(content: Column) -> Column:
    # Decoders of this format skip foreign characters; the second try does the same.
    cleaned = F.regexp_replace(content, "[^A-Za-z0-9+/=]", "")
    return F.coalesce(
        F.try_to_binary(content, F.lit("base64")), F.try_to_binary(cleaned, F.lit("base64"))
    )
