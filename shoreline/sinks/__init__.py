"""Writing tables: overwrite, append, upsert, versions, layout, exports."""
