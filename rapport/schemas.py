"""Explicit schemas of the input tables. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**columns: str) -> T.StructType:
    """Schema from column names and type names."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in columns.items()])


def _text(names: str) -> dict[str, str]:
    return {name: "string" for name in names.split()}


TABLES: dict[str, T.StructType] = {
    "users": struct(
        **_text("user_id first_name last_name email_address zip_code state phone_number"),
        date_joined="date",
        **_text("role added_method invite_code invite_code_name added_by_user_id"),
    ),
    "relationships": struct(
        **_text("user_id user_name reach_id relationship_type relationship_status"),
        relationship_created_date="date",
        relationship_created_timestamp="timestamp",
        **_text("auto_applied_tag state_file_id person_first_name person_last_name"),
    ),
    "responses": struct(
        **_text("user_id reach_id question_id question_name response_id response_value"),
        canvass_date="date",
        canvass_timestamp="timestamp",
    ),
    "response_list": struct(
        **_text("question_id question_name reach_id state_file_id response_value"),
        canvass_timestamp="timestamp",
    ),
    "survey_defs": struct(**_text("question_id name_short")),
    "contact_actions": struct(
        **_text("user_id reach_id action_type person_first_name person_last_name state_file_id"),
        action_date="date",
        action_timestamp="timestamp",
    ),
    "tag_history": struct(
        **_text("user_id reach_id state_file_id tag_id tag_name tag_action"),
        tag_date="date",
        tag_timestamp="timestamp",
    ),
    "people": struct(**_text("state_file_id phone")),
    "tag_log": struct(**_text("alloy_sos_id voting_status")),
    "absentee": struct(
        myv_van_id="string",
        date_request_received="date",
        date_ballot_mailed="date",
        date_ballot_received="date",
        date_early_voted="date",
    ),
    "voter_file": struct(
        **_text(
            "sos_id person_id myv_van_id master_registration_id first_name middle_name last_name "
            "age_combined gender_combined primary_phone_number voting_street_address "
            "voting_street_address_2 voting_city state_code voting_zip voting_address_id household_id"
        ),
        reg_on_current_file="boolean",
    ),
    "election_voted": struct(**_text("registration_id election_id")),
    "scores": struct(
        person_id="string",
        modeled_support_score="double",
        gotv_score="double",
        model_support_score="double",
    ),
    "external_responses": struct(
        **_text(
            "person_id myv_van_id master_survey_question_id master_survey_response_id "
            "survey_question_id survey_response_id"
        ),
        datetime_canvassed="timestamp",
        msq_currency="int",
        sq_currency="int",
    ),
    "notes": struct(**_text("myc_van_id note_text note_category_name")),
    "person_records": struct(**_text("myc_van_id myv_van_id")),
    "crosswalk": struct(**_text("reach_id sos_id")),
    "training_tracker": struct(row_no="bigint", **_text("invite_code phone_number cm_name email_address")),
    "leader_codes": struct(**_text("invite_code rmm pod rmm_email")),
    "support_names": struct(
        **_text("master_survey_question_id master_survey_response_id master_survey_response_name")
    ),
    "plan_names": struct(**_text("survey_question_id survey_response_id survey_response_name")),
    "phone_numbers": struct(**_text("myv_van_id phone_number")),
}

PERSON = struct(
    **_text(
        "voter support_id support_id_numeric vote_plan detailed_plan vol_ask triplers outreach "
        "sos_id tier tier_str voting_status"
    )
)
MEMBER = T.StructType(
    struct(
        **_text("user_id date_joined user_name email_address phone_number last_activity voting_status")
    ).fields
    + [T.StructField("network", T.ArrayType(PERSON))]
)
LEADER = T.StructType([T.StructField("rmm", T.StringType()), T.StructField("cms", T.ArrayType(MEMBER))])
# one JSON object: pod name -> its leaders -> their members -> their people
ORG = T.MapType(T.StringType(), T.ArrayType(LEADER))

VOLUNTEER_PERSON = struct(
    **_text(
        "reach_id auto_applied_tag person_first_name person_last_name support_id vote_plan "
        "detailed_plan vol_ask voting_status only_reachable_by_reacher triplers tier"
    )
)
VOLUNTEER = T.StructType(
    struct(**_text("user_id user_name phone_number date_joined zip_code state")).fields
    + [T.StructField("network", T.ArrayType(VOLUNTEER_PERSON))]
)
VOLUNTEERS = T.StructType([T.StructField("users", T.ArrayType(VOLUNTEER))])

# the figures the templates are fitted from and scaled to
GROWTH_TEMPLATE = struct(
    group="string",
    day="date",
    users_ptg="double",
    matched_voters_ptg="double",
    reach_adds_ptg="double",
    voters_per_cm_week_ptg="double",
    votes_ptg="double",
)
TOPLINE_TEMPLATE = struct(date_joined="date", matched_voters="bigint", reach_adds="bigint")
ID_LABEL = struct(id="string", label="string")
RESULTS = T.StructType(
    [T.StructField("people", T.ArrayType(struct(person_id="string", status="string")))]
)
