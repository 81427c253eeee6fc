"""Jobs made of several operators: fitting, weekly refresh, history."""
