"""Part of the ligatura record-linkage engine."""
