"""Writers and catalog registration."""
