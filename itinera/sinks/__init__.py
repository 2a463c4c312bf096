"""Writers and table mutation expressed as one atomic overwrite or append."""
