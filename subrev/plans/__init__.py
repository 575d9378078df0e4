"""Stage plans: clean, features, reports; lazy versions and jobs that write each stage."""
