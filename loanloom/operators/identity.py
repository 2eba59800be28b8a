"""Cross-validation of vendor responses against the customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.similarity import jaro_winkler
from loanloom.functions.text import name_uuid, normalize_email, normalize_phone, piped, strip
from loanloom.operators.keys import splittable
from loanloom.schemas import conform

RULE_VERSION = "v1.0"

# Fixed values of the matching policy.
AUTO_MATCH_THRESHOLD = 0.92
MANUAL_REVIEW_THRESHOLD = 0.80
NAME_WEIGHT = 0.6
DOB_WEIGHT = 0.4

PROFILE_COLUMNS = ("emirates_id", "full_name", "dob", "email", "phone")
EXCEPTION_DECISIONS = ("MANUAL_REVIEW", "NO_MATCH", "MISMATCH")


def _match_flag(condition: Column) -> Column:
    """MATCH only where the condition is known to hold."""
    return F.when(condition, "MATCH").otherwise("MISMATCH")


def aecb_identity_status(returned: Column, on_file: Column) -> Column:
    return _match_flag(strip(returned) == strip(on_file))


def fraud_identity_status(phone: Column, email: Column, profile_phone: Column, profile_email: Column) -> Column:
    return _match_flag(
        (normalize_phone(phone) == normalize_phone(profile_phone))
        & (normalize_email(email) == normalize_email(profile_email))
    )


def name_similarity(left: Column, right: Column) -> Column:
    return jaro_winkler(F.lower(strip(left)), F.lower(strip(right)))


def dob_match(profile_dob: Column, returned_dob: Column) -> Column:
    return F.coalesce(profile_dob == returned_dob, F.lit(False))


def aml_raw_score(profile_name: Column, profile_dob: Column, name: Column, dob: Column) -> Column:
    """The unrounded composite score."""
    birth = F.when(dob_match(profile_dob, dob), 1.0).otherwise(0.0)
    return F.lit(NAME_WEIGHT) * name_similarity(profile_name, name) + F.lit(DOB_WEIGHT) * birth


def aml_match_score(raw_score: Column) -> Column:
    return F.round(raw_score, 3).cast("decimal(4,3)")


def aml_match_decision(raw_score: Column) -> Column:
    """Decision on the unrounded score; an undefined score is no match."""
    return (
        F.when(raw_score >= AUTO_MATCH_THRESHOLD, "AUTO_MATCH")
        .when(raw_score >= MANUAL_REVIEW_THRESHOLD, "MANUAL_REVIEW")
        .otherwise("NO_MATCH")
    )


def aml_decision_only(profile_name: Column, profile_dob: Column, name: Column, dob: Column) -> Column:
    """The decision without the score.

    Without a matching birth date the score cannot reach the review threshold,
    so those names are not even sent to the Python worker's matcher.
    """
    same_birth = dob_match(profile_dob, dob)
    similarity = name_similarity(F.when(same_birth, profile_name), name)
    return aml_match_decision(F.lit(NAME_WEIGHT) * similarity + F.lit(DOB_WEIGHT))


def join_profile(responses: DataFrame, profile: DataFrame) -> DataFrame:
    """Responses with their customer's profile as ``profile_*`` columns.

    The profile has one row per customer, so a customer with very many
    responses is a hot key on the splittable side only.
    """
    side = profile.filter(F.col("internal_uuid").isNotNull()).select(
        F.col("internal_uuid").alias("__uuid"), *[F.col(c).alias(f"profile_{c}") for c in PROFILE_COLUMNS]
    )
    return responses.join(side, splittable(F.col("internal_uuid"), F.col("__uuid")), "inner").drop("__uuid")


def _identifiers(df: DataFrame, *carried: str) -> DataFrame:
    """A row per normalised phone and email, out of one pass."""
    values = F.array(
        F.struct(F.lit("phone").alias("matched_on"), normalize_phone(F.col("phone")).alias("matched_value")),
        F.struct(F.lit("email").alias("matched_on"), normalize_email(F.col("email")).alias("matched_value")),
    )
    rows = df.select(*carried, F.explode(values).alias("v")).select(*carried, "v.*")
    return rows.filter(F.col("matched_value").isNotNull())


def owner_index(profile: DataFrame) -> DataFrame:
    """Who owns which phone and email: ``matched_on, matched_value, owner_uuid``.

    Linear in the profiles. Written once a run, it answers `cross_uuid_collision`
    and `collision_owners`; a repeated profile row is one owner.
    """
    owned = _identifiers(profile.withColumnRenamed("internal_uuid", "owner_uuid"), "owner_uuid")
    return owned.filter(F.col("owner_uuid").isNotNull()).select("matched_on", "matched_value", "owner_uuid").distinct()


def cross_uuid_collision(fraud: DataFrame, profile: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Responses whose phone or email belongs to another customer.

    One row per response and matched attribute, with one other owner and how
    many others there are (`collision_owners` names all of them). Owners are
    counted per value before the join, so a value shared by very many customers
    never becomes a set of pairs. ``index`` is a stored `owner_index`.
    """
    index = owner_index(profile) if index is None else index
    owners = index.groupBy(F.col("matched_on").alias("__on"), F.col("matched_value").alias("__value")).agg(
        F.count(F.lit(1)).alias("owners"),
        F.min("owner_uuid").alias("first_owner"),
        F.max("owner_uuid").alias("last_owner"),
    )
    own = index.select(
        F.col("matched_on").alias("own_on"), F.col("matched_value").alias("own_value"), F.col("owner_uuid").alias("own_uuid")
    )
    returned = _identifiers(fraud, "application_id", "internal_uuid")
    value = F.col("matched_value")
    hits = (
        returned.join(owners, splittable(value, F.col("__value")) & F.col("matched_on").eqNullSafe(F.col("__on")), "inner")
        .filter((F.col("owners") > 1) | (F.col("first_owner") != F.col("internal_uuid")))
        .join(
            own,
            (F.col("internal_uuid") == F.col("own_uuid")) & (value == F.col("own_value")) & (F.col("matched_on") == F.col("own_on")),
            "left",
        )
    )
    return hits.select(
        "application_id",
        "internal_uuid",
        "matched_on",
        "matched_value",
        F.when(F.col("first_owner") != F.col("internal_uuid"), F.col("first_owner"))
        .otherwise(F.col("last_owner"))
        .alias("other_internal_uuid"),
        (F.col("owners") - F.when(F.col("own_uuid").isNotNull(), 1).otherwise(0)).alias("other_owner_count"),
    )


def collision_owners(collisions: DataFrame, index: DataFrame) -> DataFrame:
    """Every owner of every value in which responses collide.

    One row per value and owner, not per response and owner: the values are made
    distinct first, so the result is never larger than the index. A response's
    other owners are those of its value but for its own customer.
    """
    shared = collisions.select(F.col("matched_on").alias("__on"), F.col("matched_value").alias("__value")).distinct()
    same = splittable(F.col("matched_value"), F.col("__value")) & F.col("matched_on").eqNullSafe(F.col("__on"))
    return index.join(shared, same, "left_semi")


# --- audit rows ---------------------------------------------------------------


def _audit(
    joined: DataFrame, source: str, submitted: Column, returned: Column, match_type: str, score: Column,
    decision: Column, reason: Column, as_of: str,
) -> DataFrame:
    rows = joined.select(
        "application_id",
        "internal_uuid",
        F.lit(source).alias("source_system"),
        submitted.alias("submitted_identifier"),
        returned.alias("returned_identifier"),
        F.lit(match_type).alias("match_type"),
        score.alias("match_score"),
        decision.alias("match_decision"),
        reason.alias("exception_reason"),
        F.lit(RULE_VERSION).alias("rule_version"),
        F.current_timestamp().alias("evaluated_at"),
        F.lit(as_of).cast("date").alias("batch_date"),
        name_uuid(F.lit(source), F.col("application_id"), F.col("bronze_id"), F.lit(RULE_VERSION), F.lit(as_of)).alias(
            "audit_id"
        ),
    )
    return conform(rows, "silver.match_audit")


def _deterministic(joined: DataFrame, source: str, submitted: Column, returned: Column, status: Column,
                   reason: str, as_of: str) -> DataFrame:
    matched = status == "MATCH"
    return _audit(
        joined, source, submitted, returned, "DETERMINISTIC", F.lit(None),
        F.when(matched, "AUTO_MATCH").otherwise("MISMATCH"), F.when(~matched, reason), as_of,
    )


def audit_aecb(joined: DataFrame, as_of: str) -> DataFrame:
    """Audit rows of bureau responses joined to their profile."""
    returned, on_file = F.col("emirates_id"), F.col("profile_emirates_id")
    return _deterministic(
        joined, "aecb", on_file, returned, aecb_identity_status(returned, on_file), "emirates_id_mismatch", as_of
    )


def audit_fraud(joined: DataFrame, as_of: str) -> DataFrame:
    """Audit rows of fraud responses joined to their profile."""
    returned = (F.col("phone"), F.col("email"))
    on_file = (F.col("profile_phone"), F.col("profile_email"))
    return _deterministic(
        joined, "fraud", piped(*on_file), piped(*returned), fraud_identity_status(*returned, *on_file),
        "cross_uuid_collision", as_of,
    )


def audit_aml(joined: DataFrame, as_of: str) -> DataFrame:
    """Audit rows of AML responses joined to their profile.

    If the frame was scored already (``raw_score``) names are not matched again.
    """
    on_file = (F.col("profile_full_name"), F.col("profile_dob"))
    returned = (F.col("returned_name"), F.col("returned_dob"))
    if "raw_score" not in joined.columns:
        joined = joined.withColumn("raw_score", aml_raw_score(*on_file, *returned))
    decision = aml_match_decision(F.col("raw_score"))
    reason = F.when(decision == "MANUAL_REVIEW", "weak_name_similarity").when(
        decision == "NO_MATCH", "no_match_against_watchlist_screening"
    )
    return _audit(
        joined, "aml", piped(*on_file), piped(*returned), "PROBABILISTIC", aml_match_score(F.col("raw_score")),
        decision, reason, as_of,
    )


def union_match_audit(*audits: DataFrame) -> DataFrame:
    """One audit log of all vendors."""
    combined = audits[0]
    for audit in audits[1:]:
        combined = combined.unionByName(audit)
    return combined


def match_exceptions(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("match_decision").isin(*EXCEPTION_DECISIONS))


def manual_review_queue(audit: DataFrame) -> DataFrame:
    """Audit rows that wait for a reviewer, aged from their evaluation."""
    return audit.filter(F.col("match_decision") == "MANUAL_REVIEW").withColumn("queued_at", F.col("evaluated_at"))
