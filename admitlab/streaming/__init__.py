"""admitlab.streaming."""
