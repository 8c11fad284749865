"""Rules of the curation pipeline as data; the operators of ``rules`` take these or any others."""

from __future__ import annotations

# Every limit, anchor, weight, label and name below has to be this one for results to agree.

#: Gates of a window: column, comparison, limit, label of the failure; tracking, then gesture, then noise.
GATES = (
    ("smplh_valid_frac", ">=", 0.90, "smplh_invalid"),
    ("smplh_longest_invalid_s", "<=", 1.0, "smplh_invalid_run"),
    ("hand_frozen_frac", "<=", 0.05, "hand_pose_frozen"),
    ("kp_conf_p10", ">=", 0.30, "keypoints_missing"),
    ("implausible_frac", "<=", 0.002, "implausible_speed"),
    ("speech_seconds", ">=", 8.0, "too_little_speech"),
    ("gesture_frac_speech", ">=", 0.35, "static_while_speaking"),
    ("speech_segments_covered", ">=", 0.40, "gesture_not_sustained"),
    ("episode_count_speech", ">=", 3.0, "too_few_episodes"),
    ("wrist_excursion_p90_mm", ">=", 80.0, "motion_too_small"),
    ("elbow_excursion_p90_mm", ">=", 35.0, "wrist_only_motion"),
    ("gesture_speech_ratio", ">=", 1.05, "motion_not_speech_linked"),
    ("posture_spread_mm", ">=", 150.0, "one_posture_only"),
    ("wrist_height_p75_mm", ">=", -300.0, "hands_below_gesture_space"),
    ("hands_together_frac", "<=", 0.55, "hands_clasped"),
    ("arm_abduction_p75_deg", ">=", 17.0, "elbows_pinned"),
    ("consistency_r", ">=", 0.45, "channels_disagree"),
    ("step_cosine_p50", ">=", -0.30, "motion_is_detector_noise"),
)
#: Label of a window whose status isn't "ok".
UNMEASURABLE = "unmeasurable"

#: Disqualifiers of a clip, all of them reported; the composite score comes last.
DISQUALIFIERS = (
    ("speech_seconds", ">=", 8.0, "too_little_speech"),
    ("gesture_frac_speech", ">=", 0.50, "static_while_speaking"),
    ("wrist_height_p75_mm", ">=", -260.0, "hands_parked_low"),
    ("episode_count_speech", ">=", 3.0, "too_few_episodes"),
    ("episode_median_s", ">=", 0.55, "episodes_too_brief"),
    ("speech_segments_covered", ">=", 0.60, "gesture_not_sustained"),
    ("articulation_ratio", ">=", 2.0, "motion_is_global"),
    ("step_cosine_p50", ">=", 0.25, "motion_is_detector_noise"),
    ("consistency_r", ">=", 0.70, "channels_disagree"),
    ("gesture_quality", ">=", 0.34, "below_quality_threshold"),
)

#: Ramps of the composite score: column, value that scores 0, value that scores 1.
RAMPS = {
    "elevation": ("wrist_height_p75_mm", -300.0, -40.0),
    "reach": ("wrist_range_mm", 540.0, 860.0),
    "abduction": ("arm_abduction_p75_deg", 18.0, 45.0),
    "spread": ("posture_spread_mm", 175.0, 315.0),
    "coverage": ("gesture_frac_speech", 0.45, 0.92),
    "episode_length": ("episode_median_s", 0.55, 3.0),
    "vigour": ("arm_speed_speech_p50_mm_s", 95.0, 310.0),
    "coherence": ("step_cosine_p50", 0.10, 0.80),
}
DIMENSIONS = {"posture": ("elevation", "reach", "abduction", "spread"), "persistence": ("coverage", "episode_length"), "vigour": ("vigour",), "integrity": ("coherence",)}
WEIGHTS = {"posture": 0.40, "persistence": 0.30, "vigour": 0.10, "integrity": 0.20}

#: Parts of the review score: column, scale, weight.
CLIP_SCORE = (
    ("gesture_frac_speech", 1.0, 0.25),
    ("speech_segments_covered", 1.0, 0.20),
    ("posture_spread_mm", 320.0, 0.20),
    ("wrist_excursion_p90_mm", 300.0, 0.15),
    ("speech_seconds", 20.0, 0.10),
    ("episode_count_speech", 8.0, 0.10),
)

#: Measures that a review item takes as means over its clips.
ITEM_MEANS = (
    "gesture_frac_speech",
    "speech_segments_covered",
    "wrist_excursion_p90_mm",
    "elbow_excursion_p90_mm",
    "gesture_speech_ratio",
    "sync_r",
    "consistency_r",
    "smplh_valid_frac",
    "hand_frozen_frac",
    "hand_artic_p75_rad_s",
    "arm_speed_speech_p50_mm_s",
    "torso_travel_mm_s_p50",
    "step_cosine_p50",
    "posture_spread_mm",
    "wrist_height_p75_mm",
    "hands_together_frac",
    "arm_abduction_p75_deg",
)

#: Eligibility of a file: excluded rasters and interaction types, frame rates, drift and length in seconds.
EXCLUDED_RASTERS = ("2160x2160", "1920x1080", "640x480", "3840x2160")
EXCLUDED_INTERACTIONS = ("charades",)
FRAME_RATES, MOST_DRIFT_S, LEAST_DURATION_S = (20.0, 61.0), 0.5, 40.0
#: Reasons in order; the first that holds counts.
REASONS = ("incomplete_bundle", "no_video_stream", "probe_failed", "excluded_raster", "unusable_frame_rate", "timebase_drift", "no_speech_activity", "too_short")
POPULATION = {
    "file_id": "string",
    "vendor": "string",
    "label": "string",
    "split": "string",
    "source_relbase": "string",
    "session_id": "string",
    "participant_id": "string",
    "interaction_id": "string",
    "interaction_type": "string",
    "raster": "string",
    "nominal_fps": "double",
    "observed_duration_s": "double",
    "npz_size_bytes": "bigint",
    "eligible": "boolean",
    "ineligible_reason": "string",
}
