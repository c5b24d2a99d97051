"""Where sales rows come from."""
