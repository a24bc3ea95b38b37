"""Writers: layouts, compaction, conversion and keyed upserts."""
