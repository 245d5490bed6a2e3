"""Schemas of manifests and feature tables."""

RAW_UNLABELED = "audio_id string, audio_path string, duration double, sample_rate int, channels int, dataset string, language string, split string, source_clips string"
RAW_LABELED = "audio_id string, audio_path string, duration double, text string, sample_rate int, channels int, dataset string, language string, split string, speaker_id string"
SEGMENTS = (
    "segment_id string, source_audio_id string, source_manifest string, source_line_number bigint, source_audio_path string, "
    "source_audio_relpath string, dataset string, language string, source_split string, source_duration double, source_sample_rate int, "
    "source_channels int, source_clips string, vad_start double, vad_end double, vad_duration double, vad_run_id string, vad_model string, vad_threshold double"
)
FEATURE_HEAD = (
    "audio_id string, feature_type string, feature_version string, status string, source_manifest string, source_line_number bigint, "
    "audio_path string, dataset string, language string, split string"
)
ERROR_TAIL = "error_type string, error string"
