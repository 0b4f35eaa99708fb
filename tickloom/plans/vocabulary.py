"""Names of states (fixed values: other programs read and write them)."""

from __future__ import annotations

PASS, FAIL, SKIPPED, PARTIAL = "PASS", "FAIL", "SKIPPED", "PARTIAL"
#: States of a quote source's clock offset.
PENDING = "TIMESTAMP_SEMANTICS_PENDING"
OFFSET_VERIFIED = "OFFSET_VERIFIED_FOR_SESSION"
UTC_VERIFIED = "UTC_EPOCH_VERIFIED"
UNSAFE = "CALIBRATION_UNSAFE_FOR_JOIN"
VERIFIED = (OFFSET_VERIFIED, UTC_VERIFIED)
#: Events of the same state.
DST_SHIFT, OFFSET_CHANGE = "DST_SHIFT_DETECTED", "OFFSET_CHANGE_DETECTED"
DOWNGRADED, MARKED_UNSAFE = "DOWNGRADED_AFTER_STALE_GAP", "MARKED_UNSAFE_FOR_JOIN"
