"""Writers: stamped result directories, watermark state, monthly partitions."""
