"""The end-to-end jobs: train and predict labels; prepare, write and score titles."""
