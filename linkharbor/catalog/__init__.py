"""The registered queries, the inputs they read and the SQL they are compared with."""
