"""Label sets and rules. Ids, codes and answer texts are parameters; the status,
tier and event labels below are fixed values that reports show as they stand."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values: (date column, raw status, tag form), first date present wins.
STATUS_STEPS = (
    ("date_early_voted", "Early Voted", "early_voted"),
    ("date_ballot_received", "Ballot Received", "ballot_received"),
    ("date_ballot_mailed", "Ballot Mailed", "ballot_mailed"),
    ("date_request_received", "Request Received", "request_received"),
)
NEEDS_TO_VOTE = "Needs to Vote"
HAS_VOTED = "Has Voted!"
NEEDS_TO_RETURN = "Needs to Return Ballot"
VOTED_RAW = ("Early Voted", "Ballot Received")
MAILED_RAW = "Ballot Mailed"
UNMATCHED_STATUS = "Unable to match to Voter File"
UNMATCHED_PRIORITY = 5

# How a person was added, and the tier texts.
MATCHED_TAG = "Voter"
ADDED_TAG = "Reach Add"
TIER_TEXT = {1: "Tier 1", 2: "Tier 2", 3: "Tier 3", 4: "Not a Target"}

# Event kinds of the activity feed.
ACTION_CONTACT = "Contacted"
ACTION_RELATIONSHIP = "Added Relationship"
ACTION_ANSWER = "Marked Survey Response"
ACTION_TAG = "Added Tag"
ACTION_JOINED = "Joined Reach"

# Output columns of the wide answer table and the question each shows.
WIDE_ANSWERS = {
    "support_id": ("ID", "response_value"),
    "support_id_numeric": ("ID", "response_numeric"),
    "vote_plan": ("Plan", "response_value"),
    "detailed_plan": ("Detailed Plan", "response_value"),
    "vol_ask": ("Vol Ask", "response_value"),
    "triplers": ("Triplers", "response_value"),
    "outreach": ("OutReach", "response_value"),
}


@dataclass(frozen=True)
class ScoreRules:
    """How multi-select answers become a number: the first text contained decides."""

    scores: tuple[tuple[str, int], ...]
    ignored: str
    scored_name: str = "ID"
    multi_select: tuple[str, ...] = ("ID", "Plan")


@dataclass(frozen=True)
class SupportCodes:
    """Which external answers count, and which codes mean for, undecided, against."""

    questions: tuple[str, ...] = ()
    support: tuple[str, ...] = ()
    undecided: tuple[str, ...] = ()
    against: tuple[str, ...] = ()


@dataclass(frozen=True)
class TierRules:
    codes: SupportCodes = field(default_factory=SupportCodes)
    high_support: float = 0.8
    high_gotv: float = 0.8
    mid_gotv: float = 0.4
    mid_support: float = 0.6
    low_support: float = 0.4


@dataclass(frozen=True)
class GrowthQuestions:
    support: str
    plan: str
