"""Lead intake: bot filter, validation, campaign lookup, outcome, list membership."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The hidden field only bots fill, and the field that names the campaign.
TRAP_FIELD = "hp_field"
SLUG_FIELD = "landing_slug"

# What can become of a request, in the order the checks are made.
RATE_LIMITED = "rate_limited"
INVALID_JSON = "invalid_json"
INVALID_BODY = "invalid_body"
MISSING_SLUG = "missing_landing_slug"
UNKNOWN_CAMPAIGN = "unknown_landing"
BOT = "bot"
INVALID = "invalid"
NOT_READY = "landing_not_ready"
OK = "ok"

# Local part without leading, doubled or trailing dots, then a dotted domain.
EMAIL = r"^([A-Za-z0-9_'+\-]+\.)*[A-Za-z0-9_'+\-]*[A-Za-z0-9_+\-]@([A-Za-z0-9][A-Za-z0-9\-]*\.)+[A-Za-z]{2,}$"


@dataclass(frozen=True)
class FieldRule:
    """A payload field: its least length or its e-mail shape, and the error text."""

    name: str
    message: str
    min_length: int | None = None
    email: bool = False

    def broken(self, value: Column) -> Column:
        if self.email:
            return F.coalesce(~value.rlike(EMAIL), F.lit(True))
        return F.coalesce(F.length(value) < self.min_length, F.lit(True))


# The fields of a lead form.
LEAD_RULES = (
    FieldRule("nombre", "Nombre requerido", min_length=2),
    FieldRule("email", "Email inválido", email=True),
    FieldRule("telefono", "Teléfono requerido", min_length=7),
)


def payload(body: Column) -> Column:
    """A JSON body as VARIANT, null when it is no JSON."""
    return F.try_parse_json(body)


def text_field(value: Column, name: str) -> Column:
    """A field of a payload when it holds a text, else null."""
    is_text = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant")) == "STRING"
    return F.when(is_text, F.try_variant_get(value, f"$.{name}", "string"))


def is_bot(trap: Column) -> Column:
    """The trap field holds a non-empty text."""
    return F.coalesce(F.length(trap) > 0, F.lit(False))


def validation_errors(value: Column, rules=LEAD_RULES) -> Column:
    """Field to error text for each broken rule; empty when the payload is valid."""
    marks = []
    for rule in rules:
        marks += [F.lit(rule.name), F.when(rule.broken(text_field(value, rule.name)), F.lit(rule.message))]
    return F.map_filter(F.create_map(*marks), lambda _, message: message.isNotNull())


def known_fields(value: Column, rules=LEAD_RULES) -> Column:
    """The payload with only the fields the rules know."""
    return F.struct(*[text_field(value, rule.name).alias(rule.name) for rule in rules])


def find_campaign(requests: DataFrame, campaigns: DataFrame, slug: str = "slug") -> DataFrame:
    """Add ``campaign, list_id, success_url``; all null for an unknown slug.

    Campaigns are configuration; the optimizer broadcasts them while they are small.
    """
    known = campaigns.select(F.col("slug").alias("campaign"), "list_id", "success_url")
    return requests.join(known, F.col(slug) == F.col("campaign"), "left")


def outcome(value: Column, allowed: Column, campaign: Column, list_id: Column, rules=LEAD_RULES) -> Column:
    """What becomes of a request: the first check that applies.

    ``value`` is its parsed payload; being looked at many times, it should be a column
    of its own.
    """
    slug = text_field(value, SLUG_FIELD)
    kind = F.schema_of_variant(value)
    return (
        F.when(~allowed, RATE_LIMITED)
        .when(value.isNull(), INVALID_JSON)
        .when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), INVALID_BODY)
        .when(F.coalesce(F.length(slug) < 1, F.lit(True)), MISSING_SLUG)
        .when(campaign.isNull(), UNKNOWN_CAMPAIGN)
        .when(is_bot(text_field(value, TRAP_FIELD)), BOT)
        .when(F.size(validation_errors(value, rules)) > 0, INVALID)
        .when(list_id.isNull(), NOT_READY)
        .otherwise(OK)
    )


def client_key(forwarded: Column) -> Column:
    """The first address of a forwarding header, "unknown" without one."""
    return F.coalesce(F.trim(F.split_part(forwarded, F.lit(","), F.lit(1))), F.lit("unknown"))


def add_to_list(members: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("list_id", "contact_id")) -> DataFrame:
    """Memberships with the new ones; adding a member twice changes nothing."""
    fresh = new.select(*keys).distinct().join(members, list(keys), "left_anti")
    return members.unionByName(fresh, allowMissingColumns=True)
