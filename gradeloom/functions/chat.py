"""Functions over chat turns held in an array column."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Speaker names of the conversation format and the roles they stand for.
SPEAKER_ROLES = {"human": "user", "gpt": "assistant", "system": "system"}

# The ChatML turn markers.
CHAT_TEMPLATES = {"chatml": ("<|im_start|>", "\n", "<|im_end|>\n")}

# Paging keys, the identifier suffix and the structural tags they lead to.
PAGE_TOKEN, PAGE_SIZE, ID_SUFFIX = "pageToken", "pageSize", "Id"
TAG_PAGINATION, TAG_PAGE_SIZE_ONLY = "pagination", "page-size-only"
TAG_FILTERED, TAG_NO_PARAMS, TAG_PATH_PARAM = "filtered", "no-params", "path-param"


def turn(role: Column | str, content: Column, role_field: str = "role", content_field: str = "content") -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias(role_field), content.alias(content_field))


def request_messages(messages: Column) -> Column:
    """The turns sent to a model: assistant turns dropped, only role and content kept."""
    asked = F.filter(messages, lambda m: m["role"] != "assistant")
    return F.transform(asked, lambda m: turn(m["role"], m["content"]))


def first_by_role(messages: Column, role: str) -> Column:
    """Content of the first turn of a role, null when there is none."""
    return F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["content"]


def override_system(messages: Column, prompt: Column | str) -> Column:
    """One given system turn followed by the user turns only."""
    prompt = F.lit(prompt) if isinstance(prompt, str) else prompt
    users = F.filter(messages, lambda m: m["role"] == "user")
    return F.concat(F.array(turn("system", prompt)), F.transform(users, lambda m: turn("user", m["content"])))


def standardize_sharegpt(conversations: Column) -> Column:
    """``from``/``value`` turns as ``role``/``content``; unknown speakers pass through."""

    def role(speaker: Column) -> Column:
        chain = F
        for name, known in SPEAKER_ROLES.items():
            chain = chain.when(speaker == name, known)
        return chain.otherwise(speaker)

    return F.transform(conversations, lambda t: turn(role(t["from"]), t["value"]))


def render_chat(messages: Column, template: str | tuple[str, str, str] = "chatml") -> Column:
    """Training text of a chat, without an open assistant turn at the end."""
    start, middle, end = CHAT_TEMPLATES[template] if isinstance(template, str) else template
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(F.lit(start), m["role"], F.lit(middle), m["content"], F.lit(end)),
        ),
        "",
    )


def _indented(json_text: Column) -> Column:
    # Nested functions travel to the workers by value, so the package need not be there.
    @F.pandas_udf(StringType())
    def indented(text: pd.Series) -> pd.Series:
        return text.map(lambda t: json.dumps(json.loads(t), indent=2), na_action="ignore")

    return indented(json_text)


def render_json_block(json_text: Column) -> Column:
    """JSON text as a fenced block, two-space indent, key order kept, ASCII only.

    Spark's JSON writer has no indented form with these exact bytes, hence the Arrow UDF.
    """
    return F.concat(F.lit("```json\n"), _indented(json_text), F.lit("\n```"))


def compact_json_block(json_text: Column) -> Column:
    """Fenced block around the JSON text as it is, JVM only."""
    return F.concat(F.lit("```json\n"), json_text, F.lit("\n```"))


def param_keys(params_json: Column) -> Column:
    """Top-level keys of the parameters; none when they are absent or empty."""
    return F.coalesce(F.json_object_keys(params_json), F.array().cast("array<string>"))


def derive_tags(endpoint: Column, params_json: Column) -> Column:
    """Structural tags of an API example, in their fixed order."""
    keys = param_keys(params_json)
    n = F.size(keys)
    paging = F.array(F.lit(PAGE_SIZE), F.lit(PAGE_TOKEN))
    return F.array_compact(
        F.array(
            endpoint,
            F.when(F.array_contains(keys, PAGE_TOKEN), TAG_PAGINATION),
            F.when(F.array_contains(keys, PAGE_SIZE) & (n == 1), TAG_PAGE_SIZE_ONLY).when(n > 1, TAG_FILTERED),
            F.when(n == 0, TAG_NO_PARAMS),
            F.when(
                F.exists(keys, lambda k: ~F.array_contains(paging, k) & F.endswith(k, F.lit(ID_SUFFIX))),
                TAG_PATH_PARAM,
            ),
        )
    )
