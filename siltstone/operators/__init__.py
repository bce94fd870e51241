"""DataFrame operators: timestamps, orphan references, nested flattening."""
