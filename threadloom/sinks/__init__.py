"""Writers: inserts, upserts, overwrites and text or CSV reports."""
