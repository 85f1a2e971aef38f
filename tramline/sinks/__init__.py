"""Writers with replace, append and partition-replace semantics."""
