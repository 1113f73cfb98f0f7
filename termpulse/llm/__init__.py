"""Operations of a training-data pipeline: packing, filtering, de-duplication, scoring and binary output."""
